"""Plain Python versions of the operators, and the awkward rows that every operator has to bear."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, width=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


class Groups:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, x, y):
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def sharing(sets):
    """Pairs of keys whose sets share a member."""
    where = defaultdict(list)
    for key, members in sets.items():
        for m in members:
            where[m].append(key)
    return {(a, b) for keys in where.values() for i, b in enumerate(sorted(keys)) for a in sorted(keys)[:i]}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


LONG = " ".join(f"word{i % 977} stands{i}" for i in range(30_000))
AWKWARD = [
    (1, None, "en", None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "a", 4),
    (4, "one", "en", "b", 3),
    (5, "the same text of a few plain words that repeats itself here", "en", "b", 58),
    (6, "the same text of a few plain words that repeats itself here", "en", None, 58),
    (6, "the same text of a few plain words that repeats itself here", "en", None, 58),
    (None, "a text without an id that stands in the table all the same", "en", "b", 58),
    (7, LONG, "en", "c", len(LONG)),
    (8, LONG, "en", "c", len(LONG)),
    (9, "été ␛ <s> 𝄞 ▁ x\u0000y", "fr", "é", 20),
]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; they must not disturb them.
CLASHES = ["item", "key", "component", "component_id", "size", "score", "kept", "found", "ids", "a", "b", "gone", "first", "label", "n"]


def awkward(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD, DOC_SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
