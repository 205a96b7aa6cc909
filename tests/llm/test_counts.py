"""Phrase mining, conversation repair and token counts: against plain Python versions and the public library."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import LOWER, awkward, empty

from tabulon.llm import phrases, repair, tokencounts

# --- phrases ---


def plain_phrases(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        parts = [(p[i:j], a) for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p)]
        gone = {q for q, a in parts if a >= cand[q]}
        found = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.fixture
def small_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PART", 20_000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("least,top", [(3, 2000), (20, 7)])
def test_phrases_brute_force(spark, small_pieces, least, top):
    rnd = random.Random(3)
    words = ["a", "b", "c", "a\x01", "Ä", "d", "the", "The", "x"]
    rows = [
        (rnd.choice(["en", "de", None]), "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ",", ". ", "\n"]) for _ in range(rnd.randint(0, 60))))
        for _ in range(250)
    ]
    rows += [("en", None), ("en", ""), ("fr", "only one")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    want = plain_phrases(rows, least, top)
    assert len(want) > 15
    assert sorted(map(tuple, phrases.collocations(docs, least, top).collect())) == want


def test_phrases_of_a_stream_cut_anywhere():
    """One pass over sorted records gives the same counts however they are cut into batches and partitions."""
    import pyarrow as pa

    rnd = random.Random(1)
    rows = sorted({tuple(rnd.choice("ab") for _ in range(rnd.randint(3, 5))) for _ in range(60)})
    rows = [(*r, *[None] * (5 - len(r)), rnd.randint(1, 9)) for r in rows]
    want = Counter()
    for *w, n in rows:
        for m in range(3, 6):
            if w[m - 1]:
                want[" ".join(w[:m])] += n
    for trial in range(20):
        got = Counter()
        cuts = [0, *sorted(rnd.sample(range(1, len(rows)), 4)), len(rows)]
        stream = None
        for lo, hi in zip(cuts, cuts[1:]):
            part = rows[lo:hi]
            batch = pa.RecordBatch.from_pydict({"lang": ["x"] * len(part), **{c: [r[k] for r in part] for k, c in enumerate([*phrases.WORDS, "n"])}},
                schema=pa.schema([("lang", pa.string()), *[(c, pa.string()) for c in phrases.WORDS], ("n", pa.int64())]))
            stream = stream or phrases._Stream(7)
            tables = [stream.feed(batch)]
            if rnd.random() < 0.5 or hi == len(rows):  # a partition ends here
                tables.append(stream.close())
                stream = None
            for t in tables:
                for row in t.to_pylist():
                    got[row["phrase"]] += row["n"]
        assert {p: n for p, n in got.items() if n >= 7} == {p: n for p, n in want.items() if n >= 7}


def test_phrases_awkward(spark):
    docs = awkward(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, phrases.collocations(docs, 2).collect())) == plain_phrases(rows, 2, 2000)
    assert phrases.collocations(empty(spark)).count() == 0


# --- conversations ---

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows, faults):
    """(cost, audit, lines) by dynamic programming over (rows read, role before)."""

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    after = STEP.get((state, role[0]))
                    if after and (after not in best or (cost + 3, audit + "I") < best[after][:2]):
                        best[after] = cost + 3, audit + "I", (*lines, role + ":")
        return best

    best = inserted({"": (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def put(state, *way):
            if state not in new or way[:2] < new[state][:2]:
                new[state] = way

        for state, (cost, audit, lines) in best.items():
            put(state, cost + 4, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault else 0
            if role and (after := STEP.get((state, role[0]))):
                put(after, cost + more, audit + "K", (*lines, f"{role}:{text}"))
            for name in ("user", "assistant"):
                if after := STEP.get((state, name[0])):
                    put(after, cost + more + 3, audit + "R", (*lines, f"{name}:{text}"))
        best = inserted(new)
    return min((best[s] for s in ("", "a") if s in best), key=lambda b: b[:2])


def plain_repair(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        kept = convs[conv]
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        kept += [] if d == 0 else [(turn, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in rows:
            shown = re.sub("[\x20\x09-\x0d]", "", text)
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = cheapest(rows, faults)
        out[conv] = (gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check_repair(spark, rows):
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = repair.repair(repair.damage(docs)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == plain_repair(rows)
    assert len(got) == len({r[0] for r in rows})


def test_repair_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for c in range(300):
        for t in range(rnd.choice([1, 2, 5, 9, 30])):
            turn = rnd.choice([t, t, t, t + 1, None]) if c % 3 else t
            rows.append((c, turn, rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), rnd.choice(["Hi.", "ok", "Yes!", "a b. ", "", " \n", "What?", f"x{rnd.random()}.", None])))
    check_repair(spark, rows)


def test_repair_of_hot_conversations(spark):
    """Longer than a block, without an id, of one repeated row, of one turn."""
    rnd = random.Random(6)
    rows = [(1, t, rnd.choice(["user", "assistant"]), rnd.choice([f"x{t}.", f"y{t}"])) for t in range(900)]
    rows += [(None, t, ["user", "assistant"][t % 2], f"z {t}.") for t in range(300)]
    rows += [(2, 3, "user", "same.")] * 200 + [(3, 3, "assistant", f"{t}.") for t in range(200)] + [(4, None, "user", "q?"), (4, None, "assistant", "a.")]
    check_repair(spark, rows)


def test_repair_prices_are_a_dual(spark):
    """No price exceeds an arc's cost plus the price behind it, and the first row's prices are the cheapest costs."""
    rnd = random.Random(7)
    for _ in range(300):
        kinds = "".join(rnd.choice("suaxdSUAX") for _ in range(rnd.randint(1, 12)))
        price = repair.prices(kinds, repair.END)
        for i, kind in enumerate(kinds):
            for s in range(4):
                assert all(price[4 * i + s] <= cost + price[4 * (i + 1) + q] for _, cost, q in repair._edits(kind, s))
                assert price[4 * i + s] <= repair.INSERT + price[4 * i + repair.NEXT[s]]
        names = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "d": "user"}
        rows = [(0, names[k.lower()], "t") for k in kinds]
        faults = ["blank" if k == "d" else "truncated" if k.isupper() else None for k in kinds]
        want = cheapest(rows, faults)
        assert (price[repair.START], repair.trace(kinds, repair.END, price, repair.START)) == want[:2]


def test_repair_awkward(spark):
    rows = [(None, None, None, None), (1, 0, None, None), (1, None, "user", "a."), (2, 5, "user", " "), (3, 0, "system", "s." * 50_000), (3, 1, "user", "u")]
    check_repair(spark, rows)
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    wide = docs.selectExpr("*", *[f"'clash' AS {c}" for c in ("seq", "kind", "fault", "gone", "digest", "id", "ends", "part", "copy")])
    assert sorted(map(str, repair.repair(repair.damage(wide)).collect())) == sorted(map(str, repair.repair(repair.damage(docs)).collect()))
    assert repair.repair(repair.damage(docs.limit(0))).count() == 0


# --- token counts ---


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_counts_equal_the_library(spark, model):
    rnd = random.Random(1)
    letters = ["ab", "abc ", "aeiou nrst", "  \n\t", "▁ a▁", "<s></s>[INST]", "été𝄞漢字 x", "0123456789", "=-_*#/", "aAbB <unk>"]
    pieces = [model.id_to_piece(i).replace("▁", " ") for i in range(300, 32_000)]
    texts = []
    for _ in range(800):
        some = rnd.choice(letters) + rnd.choice(letters)
        texts.append("".join(rnd.choice(some) for _ in range(rnd.randint(0, 60))))
        texts.append("".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 12))))
    texts += ["a" * 5000, "ab" * 3000, " " * 3000, "".join(rnd.choice("etaoinshrdlu") for _ in range(20_000)), "=-" * 2000, "▁▁a", "\x00a\x00", "<0x0A>", "\r\n", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: tuple(r)[1:] for r in tokencounts.count_tokens(docs, tokencounts.load_vocabulary()).collect()}
    for i, text in enumerate(texts):
        n = len(model.encode(text or ""))
        assert got[i] == (len((text or "").encode()), n, n > 4096), text


def test_counts_on_documents(spark, tables, model):
    rows = tokencounts.count_tokens(tables("documents"), tokencounts.load_vocabulary()).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in tables("documents").collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(model.encode(t)) for i, t in texts.items()}


def test_merges_that_make_a_lower_rank():
    """A merge may make a pair that ranks before the merges still to come: those wait, as in a merge-by-merge encoder."""
    rnd = random.Random(4)
    for _ in range(300):
        letters = "abc"
        pieces = {c: 0.0 for c in letters}
        for _ in range(rnd.randint(1, 14)):
            piece = "".join(rnd.choice(letters) for _ in range(rnd.randint(2, 6)))
            pieces[piece] = float(rnd.randint(-9, 0))
        merges = tokencounts.Merges(pieces)
        texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 25))) for _ in range(20)]
        bounds = np.append(0, np.cumsum([len(t) for t in texts]))
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        want = []
        for text in texts:
            symbols = list(text)
            while found := [(-pieces[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in pieces]:
                i = min(found)[1]
                symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            want.append(len(symbols))
        assert merges.texts(points, bounds).tolist() == want


def test_counts_awkward(spark, model):
    rows = tokencounts.count_tokens(awkward(spark), tokencounts.load_vocabulary()).collect()
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()), len(model.encode(r["text"] or ""))) for r in awkward(spark).collect())
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert tokencounts.count_tokens(empty(spark), tokencounts.load_vocabulary()).count() == 0
