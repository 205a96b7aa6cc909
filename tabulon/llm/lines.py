"""Near-equal lines by a segment-partition edit join, and documents without the lines that repeat too often.

Two lines within ``EDITS`` edits agree in at least one of the ``EDITS + 1`` segments of the shorter one. Each
distinct line puts its own segments in an index, keyed by length and segment, and probes it with the substrings
that can be such a segment of a line as long or up to ``EDITS`` shorter, at the few places the remaining edits allow.
Lines that meet are compared by a banded bit-parallel edit distance. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import bucket_components
from .steps import Steps

EDITS = 2
MIN_CHARS = 20
REPEATS = 6
MIN_LEFT = 0.2


def _common_start(x: Column, y: Column) -> Column:
    """Length of the common beginning (up to two million characters), by halving steps."""
    most = F.least(F.length(x), F.length(y))
    steps = F.array(*[F.lit(1 << k) for k in range(20, -1, -1)])
    same = lambda n, s: (n + s <= most) & (F.substring(x, n + 1, s) == F.substring(y, n + 1, s))
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(same(n, s), n + s).otherwise(n))


def _without_common_start(pair: Column) -> Column:
    """The two texts without what both begin with, reversed."""
    rest = lambda text, n: F.reverse(F.substring(text, n + 1, F.length(text)))
    cut = F.transform(F.array(_common_start(pair["x"], pair["y"])), lambda n: F.struct(rest(pair["x"], n).alias("x"), rest(pair["y"], n).alias("y")))
    return F.element_at(cut, 1)


def within_edits(x: Column, y: Column, edits: int) -> Column:
    """True if the texts are at most ``edits`` insertions, deletions and substitutions apart.

    What both begin and end with is taken off first, which leaves the distance as it is; the rest is folded bit-parallel.
    """
    pair = F.array(F.struct(x.alias("x"), y.alias("y")))
    for _ in range(2):  # the start, then the reversed end
        pair = F.transform(pair, _without_common_start)
    close = F.element_at(F.transform(pair, lambda p: _banded(p["x"], p["y"], edits)), 1)
    return F.when(F.abs(F.length(y) - F.length(x)) > edits, False).otherwise(close)


def _banded(x: Column, y: Column, edits: int) -> Column:
    """``within_edits`` of two texts whose lengths differ by ``edits`` at most.

    Bit ``edits + d`` of level e says that the first i characters of x and the first i + d of y are at most e
    edits apart. A character of x moves all levels on at once: a match keeps a bit, the level below
    gives a substitution in place, a deletion from the right, an insertion from the left.
    """
    every = (1 << (2 * edits + 1)) - 1
    names = [f"r{e}" for e in range(edits + 1)]
    # before the first character only insertions are possible
    start = F.struct(F.lit(0).alias("i"), *[F.lit(sum(1 << (edits + d) for d in range(e + 1))).alias(n) for e, n in enumerate(names)])

    def matches(state: Column, char: Column, right: Column) -> Column:
        out = F.lit(0)
        for d in range(-edits, edits + 1):
            out = out.bitwiseOR(F.when(F.get(right, state["i"] + d) == char, 1 << (edits + d)).otherwise(0))
        return out

    def advance(state: Column, match: Column) -> Column:
        levels = [state["r0"].bitwiseAND(match)]
        for e in range(1, edits + 1):
            low, same = state[f"r{e - 1}"], state[f"r{e}"].bitwiseAND(match)
            levels.append(same.bitwiseOR(low).bitwiseOR(F.shiftright(low, 1)).bitwiseOR(F.shiftleft(levels[-1], 1)).bitwiseAND(F.lit(every)))
        return F.struct((state["i"] + 1).alias("i"), *[v.alias(n) for v, n in zip(levels, names)])

    def fold(right: Column) -> Column:
        def step(state: Column, char: Column) -> Column:
            return F.element_at(F.transform(F.array(matches(state, char, right)), lambda m: advance(state, m)), 1)

        return F.aggregate(F.array_remove(F.split(x, ""), ""), start, step, lambda s: s[names[-1]])

    # bound to a name, so that y is split once; an empty text splits into one empty string
    end = F.element_at(F.transform(F.array(F.array_remove(F.split(y, ""), "")), fold), 1)
    return F.call_function("shiftright", end, F.length(y) - F.length(x) + edits) % 2 == 1


def _segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """(start from 0, length) of segment i of a line: the last ``length mod parts`` segments are one longer."""
    base, longer = F.floor(length / parts).cast("int"), F.pmod(length, F.lit(parts)).cast("int")
    extra = F.greatest(F.lit(0), longer - (parts - i))
    return base * i + extra, base + F.when(longer >= parts - i, 1).otherwise(0)


def _key(i: int, length: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(i), length, text)


def index_keys(line: Column, n: Column, edits: int) -> Column:
    """Keys of the segments of a line of ``n`` characters. ``n`` is a column, so that it is counted once per line."""
    keys = []
    for i in range(edits + 1):
        start, size = _segment(n, i, edits + 1)
        keys.append(_key(i, n, F.substring(line, start + 1, size)))
    return F.array(*keys)


def probe_keys(line: Column, n: Column, edits: int, own: bool = True) -> Column:
    """Keys of the substrings that can equal segment i of a line ``less`` characters shorter; the line's own segments are among them, unless ``own`` is false.

    Left of the segment at most i edits can lie, right of it at most ``edits - i``; that leaves the shifts that keep both.
    """
    keys = []
    for less in range(edits + 1):
        for i in range(edits + 1):
            start, size = _segment(n - less, i, edits + 1)
            low, high = max(-i, less - (edits - i)), min(i, less + (edits - i))
            for shift in range(low, high + 1):
                if not (own or less or shift):
                    continue
                keys.append(_key(i, n - less, F.substring(line, start + shift + 1, size)))
    return F.array(*keys)


def _parity(line: str) -> Column:
    """Bit b: whether the characters hashed to b occur an odd number of times. An edit flips two bits at most."""
    return F.expr(f"aggregate(split({line}, ''), 0L, (s, c) -> s ^ shiftleft(1L, cast(pmod(hash(c), 64) as int)))")


def _lines(docs: DataFrame, min_chars: int, short: bool = False) -> DataFrame:
    """(doc_id, text_hash, pos, line, a, b): the lines that take part; a and b are two hashes of the line. With ``short``
    these are also the lines under ``min_chars`` characters, but not the blank ones."""
    rows = docs.filter("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.filter((F.length("line") >= min_chars) | F.lit(short) & F.col("line").rlike(r"\S")).select("*", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def line_classes(docs: DataFrame, steps: Steps, edits: int = EDITS, min_chars: int = MIN_CHARS, short: bool = False) -> DataFrame:
    """(a, b, class, class_size, first) per distinct line: its class under links of at most ``edits`` edits, how often
    lines of the class occur, and the first place (doc_id, text_hash, pos) among them. Lines under ``min_chars``
    characters, with ``short``, have classes of equal lines."""
    lines = _lines(docs, min_chars, short)
    place = F.struct("doc_id", "text_hash", "pos")
    table = lines.groupBy("a", "b").agg(F.min("line").alias("line"), F.count("*").alias("n"), F.min(place).alias("first"))
    table = steps.write(table.withColumns({"item": F.monotonically_increasing_id(), "size": F.length("line")}))

    long = table.filter(F.col("size") >= min_chars)
    # a line's own segments are in the index, so only its other substrings look there; a key counts if different lines meet under it
    segments = long.select("item", F.explode(index_keys(F.col("line"), F.col("size"), edits)).alias("key"))
    probes = long.select("item", F.explode(probe_keys(F.col("line"), F.col("size"), edits, own=False)).alias("key"))
    index = steps.write(segments.groupBy("key").agg(F.min("item").alias("lo"), F.max("item").alias("hi")))
    found = probes.join(index.hint("shuffle_hash"), "key").filter("item <> lo or item <> hi").select("key", "item")
    found = steps.write(found.distinct())
    keys = index.filter("lo < hi").select("key").union(found.select("key")).distinct()
    shared = steps.write(segments.join(keys, "key", "left_semi").select("key", "item").union(found).distinct())
    steps.drop(index, found)
    # the candidates grow with the corpus, so they meet the lines by a shuffle at every size
    keys = shared.groupBy("item").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # as many as segments and probes
    texts = table.select("item", "line", F.col("n").alias("weight")).join(keys.hint("merge"), "item")
    texts = steps.write(texts.withColumn("parity", _parity("line")))
    posts = shared.join(texts.select("item", "weight"), "item")

    def verify(found: DataFrame) -> DataFrame:
        left = texts.select(F.col("item").alias("a"), F.col("line").alias("x"), F.col("parity").alias("px"))
        right = texts.select(F.col("item").alias("b"), F.col("line").alias("y"), F.col("parity").alias("py"))
        both = found.join(left, "a").join(right, "b").filter(F.bit_count(F.col("px").bitwiseXOR(F.col("py"))) <= 2 * edits)
        return both.filter(within_edits(F.col("x"), F.col("y"), edits)).select("a", "b")

    # in the join itself: a pair counts under its first common key, then the cheap bound, then the distance
    once = F.element_at(F.array_intersect("x.keys", "y.keys"), 1) == F.col("x.key")
    near = once & (F.bit_count(F.col("x.parity").bitwiseXOR(F.col("y.parity"))) <= 2 * edits)
    near = near & within_edits(F.col("x.line"), F.col("y.line"), edits)
    group = bucket_components(posts, verify, steps, texts.drop("weight"), near)
    steps.drop(shared, texts)
    rows = table.select("item", "a", "b", "n", "first")
    linked = rows.join(group, "item")
    totals = linked.groupBy("component").agg(F.sum("n").alias("class_size"), F.min("first").alias("first"))
    linked = linked.drop("first").join(totals, "component").select("a", "b", F.col("component").alias("class"), "class_size", "first")
    alone = rows.join(group, "item", "left_anti").select("a", "b", F.col("item").alias("class"), F.col("n").alias("class_size"), "first")
    return linked.union(alone)


def dedup_lines(
    docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, repeats: int = REPEATS, min_left: float = MIN_LEFT, short: bool = False
) -> DataFrame:
    """All columns of ``docs`` with ``text`` cleaned, and n_lines, n_removed, kept, classes.

    Lines end at ``\\n``. Lines of ``min_chars`` characters or more fall into classes of equal and near-equal
    lines (at most ``edits`` edits, linked over others too). A class that occurs more than ``repeats`` times
    keeps its first occurrence, by doc_id, then place in the text; the others are removed. With ``short`` shorter lines
    take part too, in classes of equal lines; blank ones never do. ``kept`` is false for a document that has lost
    so much that nothing or less than ``min_left`` of its characters is left. ``classes`` has the members of such
    classes among the lines, (pos, class_size, first_doc_id, first_pos) by pos; positions count from 0.
    Rows with a null doc_id or null text pass unchanged. Rows that repeat a doc_id with the same text count as
    one document for places, each for occurrences. Columns named like the new ones are replaced.
    """
    steps = Steps(docs.sparkSession, "lines")
    docs = docs.drop("n_lines", "n_removed", "kept", "classes")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    often = line_classes(slim, steps, edits, min_chars, short).filter(F.col("class_size") > repeats).select("a", "b", "class_size", "first")
    often = steps.write(often)
    hits = _lines(slim, min_chars, short).select("doc_id", "text_hash", "pos", "a", "b").join(often, ["a", "b"])
    later = F.when(F.struct("doc_id", "text_hash", "pos") != F.col("first"), F.col("pos"))
    member = F.struct("pos", "class_size", F.col("first.doc_id").alias("first_doc_id"), F.col("first.pos").alias("first_pos"))
    gone = hits.groupBy("doc_id", "text_hash").agg(F.collect_set(later).alias("gone"), F.sort_array(F.collect_set(member)).alias("classes"))
    gone = steps.write(gone)
    # the row travels as one struct, so that no column of it can clash
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    match = (rows["row.doc_id"].cast("long") == gone["doc_id"]) & (F.xxhash64(rows["row.text"]) == gone["text_hash"])
    # documents with removed lines grow with the corpus, so they meet the texts by a shuffle at every size
    rows = rows.join(gone.hint("merge"), match, "left").select("row", "gone", "classes", F.split("row.text", "\n").alias("split"))
    left = F.array_except(F.sequence(F.lit(0), F.size("split") - 1), F.col("gone"))
    clean = F.array_join(F.transform(left, lambda i: F.get("split", i)), "\n")
    hit = F.coalesce(F.size("gone") > 0, F.lit(False))
    rows = rows.withColumn("clean", F.when(hit, clean).otherwise(F.col("row.text")))
    kept = ~hit | (F.length("clean") >= F.lit(min_left) * F.length("row.text")) & (F.length("clean") > 0)
    return rows.select(
        *[F.col("clean").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns],
        F.when(F.col("split").isNull(), 0).otherwise(F.size("split")).cast("long").alias("n_lines"),
        F.when(hit, F.size("gone")).otherwise(0).cast("long").alias("n_removed"),
        kept.alias("kept"),
        F.coalesce("classes", F.array().cast(gone.schema["classes"].dataType)).alias("classes"),
    )
