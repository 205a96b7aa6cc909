"""MinHash near-dedup, SpotSigs classes, passages, embeddings: against brute force over small tables."""

import hashlib
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import AWKWARD, Groups, awkward, empty, jaccard, sharing, shingles, words
from pyspark.sql import functions as F

from tabulon.llm import embeddings, graph, minhash, passages, spotsigs
from tabulon.llm import words as shingle_words
from tabulon.llm.steps import Steps


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)] + [(500, 500 + i) for i in range(30)]
    got = {r["item"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long"), Steps(spark, "t")).collect()}
    g = Groups({x for p in pairs for x in p})
    for a, b in pairs:
        g.link(a, b)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: g.find(x) for x in linked}


def test_components_of_stars(spark):
    """Links that are stars already are written once and rewritten in no round."""
    steps, written = Steps(spark, "t"), []
    write = steps.write
    steps.write = lambda df, *a: (written.append(1), write(df, *a))[1]
    pairs = [(k, 0) for k in range(1, 20)] + [(5, 0), (30, 30), (40, 41)]
    got = {r["item"]: r["component"] for r in graph.components(spark.createDataFrame(pairs, "a long, b long"), steps).collect()}
    assert got == {k: 0 for k in range(20)} | {40: 40, 41: 40} and len(written) == 1
    assert not graph.components(spark.createDataFrame([], "a long, b long"), steps).collect()


def test_steps_files(spark, monkeypatch):
    """A step of few rows is no file per partition; rows beyond the given number are all there, and files never get more."""
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 2)
    for rows, files in ((90, 4), (10**6, 50), (None, 50)):
        step = Steps(spark, "t").write(spark.range(0, 100, 1, 50), rows)
        assert len(step.inputFiles()) == files and step.count() == 100


def test_minhash_brute_force(spark, tables):
    docs = tables("documents")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    # a chain of edits, so that links alone decide the components
    base = " ".join(f"chain{i}" for i in range(120)).split()
    for k in range(8):
        rows[10_000 + k] = " ".join(base[: 120 - 4 * k] + [f"tail{k}x{j}" for j in range(4 * k)])
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    sets = {i: shingles(t) for i, t in rows.items()}
    g = Groups(rows)
    for a, b in sharing(sets):
        both = len(sets[a] & sets[b])
        if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            g.link(a, b)
    got = minhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (len(sets[i]), g.find(i), g.find(i) == i) for i in rows
    }
    assert len({g.find(10_000 + k) for k in range(8)}) < 8


def test_minhash_repeated_ids(spark):
    """Rows with one doc_id and different texts are documents of their own, and none loses a link to another."""
    rng = random.Random(8)
    bases = [[f"w{b}x{k}" for k in range(60)] for b in range(12)]
    rows = []
    for i in range(300):
        text = rng.choice(bases) + [f"end{k}" for k in range(rng.randint(0, 2))]
        rows.append((rng.choice([None, i % 9, i % 40, i]), " ".join(text if rng.random() < 0.8 else [f"own{i}x{k}" for k in range(30)])))
    rows += [(7, "c " * 20), (7, " ".join(f"z{k}" for k in range(60))), (9, " ".join(f"z{k}" for k in range(61)))]
    sets = [shingles(t) for _, t in rows]
    groups = Groups(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if None not in (rows[i][0], rows[j][0]) and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                groups.link(i, j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[groups.find(i)] = min(d, low.get(groups.find(i), d))
    want = [(d, len(s), low[groups.find(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert Counter(map(str, want)) == Counter(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in got)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and want[-1][2] == 7


def test_minhash_awkward(spark):
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in minhash.near_duplicates(awkward(spark)).collect())
    n = {i: len(shingles(t)) for i, t, *_ in AWKWARD}
    home = {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 7, 9: 9, None: None}
    assert got == sorted((str(i), n[i], str(home[i]), i is None or home[i] == i) for i, *_ in AWKWARD)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_edited_texts(spark, tables):
    rows = [(r["doc_id"], r["text"] or "") for r in tables("documents").collect()] + [(10**9, ""), (10**9 + 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(rows, reverse=True)
    want = {}
    for k, (i, text) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(text) // 2
        want[i] = (len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest())
    got = {r["doc_id"]: r for r in spotsigs.fingerprint_documents(docs).collect()}
    assert {i: (r["n_chars"], r["edited_sha256"]) for i, r in got.items()} == want
    prints = {i: r["fingerprint"] for i, r in got.items()}

    def cut(p):
        return {p[k : k + 8] for k in range(0, len(p), 8)}

    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][0]
        a, b = cut(prints[i]), cut(prints[after])
        assert math.isclose(got[i]["near_next"], jaccard(a, b) if a | b else 1.0)
        a, b = cut(prints[i]), cut(got[i]["edited_fingerprint"])
        assert math.isclose(got[i]["near_edited"], jaccard(a, b) if a | b else 1.0)
    same = {}
    for i, text in rows:
        assert same.setdefault(text, prints[i]) == prints[i]
    sets = {i: cut(p) for i, p in prints.items()}
    g = Groups(sets)
    for a, b in sharing(sets):
        if jaccard(sets[a], sets[b]) >= 0.8:
            g.link(a, b)
    assert {i: r["class_id"] for i, r in got.items()} == {i: g.find(i) for i in sets}


def test_signature_rule(spark):
    text = "The quick Fox is in the old house, und der alte Mann. The end"
    row = spark.createDataFrame([(text,)], "t string").select(
        spotsigs.signatures(F.col("t")).alias("s"),
        F.array_sort(F.array(*[F.hash(F.lit(a), F.lit(b), F.lit(c)) for a, b, c in [("the", "quick", "fox"), ("is", "old", "house"), ("the", "old", "house"), ("der", "alte", "mann")]])).alias("w"),
    )
    s, w = row.first()
    assert s == sorted(w)


def test_spotsigs_awkward(spark):
    got = spotsigs.fingerprint_documents(awkward(spark)).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and len(r["edited_sha256"]) == 64
    by = {r["doc_id"]: r for r in got}
    assert by[1]["fingerprint"] == "" and by[1]["n_chars"] == 0 and by[5]["fingerprint"] == by[6]["fingerprint"] and by[6]["class_id"] == 5
    assert spotsigs.fingerprint_documents(empty(spark)).count() == 0
    nameless = spark.createDataFrame([(None, "a b"), (None, "c d")], "doc_id long, text string")
    assert spotsigs.fingerprint_documents(nameless).count() == 2


def test_passages_planted(spark):
    rng = np.random.default_rng(3)
    fresh = lambda n: [f"w{v}" for v in rng.integers(0, 10**9, n)]
    docs, planted = {}, [fresh(60 + 5 * k) for k in range(12)]
    for i in range(120):
        w = fresh(int(rng.integers(40, 200)))
        if i % 3 == 0:
            at = int(rng.integers(0, len(w)))
            w = w[:at] + planted[(i // 3) % 12] + w[at:]
        docs[i] = " ".join(w)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    spans = passages.repeated_passages(frame)
    got = spans.collect()
    first = {k: 3 * k for k in range(12)}
    hit = {r["doc_id"] for r in got}
    assert hit == {i for i in docs if i % 3 == 0 and i not in first.values()}
    for r in got:
        text = docs[r["doc_id"]][r["start_char"] : r["start_char"] + r["n_chars"]]
        kept = r["kept_doc_id"]
        # to the ends of the common run; a near-equal paragraph at an end may have a word or two of its own
        common = " ".join(planted[(r["doc_id"] // 3) % 12])
        assert common in text and len(text.split()) == r["n_words"] <= len(common.split()) + 3
        assert common in docs[kept] and kept < r["doc_id"] and kept % 3 == 0 and (kept // 3) % 12 == (r["doc_id"] // 3) % 12
    left = {r["doc_id"]: r["text"] for r in passages.without_passages(frame, spans).collect()}
    cut = {r["doc_id"]: r for r in got}
    for i, text in docs.items():
        c = cut.get(i)
        assert left[i] == (text if c is None else text[: c["start_char"]] + text[c["start_char"] + c["n_chars"] :])


def test_shared_posts_are_made_once(spark):
    """Keys over several batches, alone at their ends, and frequent ones; nothing is read or made a second time."""
    rng = np.random.default_rng(5)
    keys = [*map(int, rng.integers(-40, 40, 60)), *[7] * 25, *range(100, 120)]
    table = [(k, d, 0, 0) for d, k in enumerate(keys)]
    posts = spark.createDataFrame(table, "key long, doc_id long, version long, pos int")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "2", "3", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            shared = passages.shared_posts(posts)
            got = sorted(map(tuple, shared.collect()))
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        count = Counter(k for k, *_ in table)
        assert got == sorted(r for r in table if count[r[0]] > 1)
    assert shared._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hash") == 1
    assert passages.shared_posts(posts.limit(0)).count() == 0


def test_keyed_sets(spark):
    """Sets have the keys of their paragraphs, over several batches and whatever else the rows hold."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 9, n)) for n in (*rng.integers(1, 40, 60), 1, 2, 300)]
    docs = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc_id long, version long, text string")
    want = {}
    for r in passages.band_posts(docs, 5, 3, 5, 5, 80).collect():
        want.setdefault((r["doc_id"], r["pos"]), set()).add(r["key"])
    places = docs.crossJoin(spark.range(200).select(F.col("id").cast("int").alias("pos"))).join(spark.createDataFrame(list(want), "doc_id long, pos int"), ["doc_id", "pos"])
    sets = passages.paragraph_sets(docs.join(places.groupBy("doc_id").agg(F.collect_list("pos").alias("wanted")), "doc_id"), 5, 5)
    sets = spark.createDataFrame(sets.collect(), sets.schema)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    for size in ("1", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            rows = passages.keyed_sets(sets, 5, 3, 80).collect()
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
        assert {(r["doc_id"], r["pos"]): set(r["keys"]) for r in rows} == want and all(len(r["keys"]) == len(set(r["keys"])) for r in rows)
        assert sum(len(r["keys"]) == 1 for r in rows) and sum(len(r["keys"]) == 5 for r in rows)
    assert passages.keyed_sets(sets.limit(0), 5, 3, 80).count() == 0


def test_distinct_hashes_in_order():
    """Also where hashes differ in their last bits only."""
    rng = np.random.default_rng(3)
    for owners in (1, 2, 50, 300):
        owner = np.sort(rng.integers(0, owners, 900))
        hashes = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
        hashes[::3] = hashes[0]
        hashes[1::5] = hashes[0] ^ np.uint64(1)
        got = shingle_words.distinct(hashes, owner, owners)
        for o in range(owners):
            assert got.hashes[got.bounds[o] : got.bounds[o + 1]].tolist() == sorted(set(hashes[owner == o].tolist()))


def test_passages_brute_force_cuts():
    rng = np.random.default_rng(5)
    h = passages.mix(rng.integers(0, 6, 600).astype(np.uint64))
    h[200:260] = h[200]
    bounds = np.array([0, 0, 3, 150, 150, 600])
    want, value = set(), {}
    for a, b in zip(bounds, bounds[1:]):
        for i in range(a, b):
            v = passages.mix(h[i : i + 1] ^ passages._CUT)
            for k, factor in ((1, passages._SECOND), (2, passages._THIRD)):
                v = v + passages.mix((h[i + k : i + k + 1] if i + k < b else np.zeros(1, np.uint64)) * factor)
            value[i] = int(passages.mix(v)[0])

        def least(i, n, a=a, b=b):
            return i - a >= n and b - i > n and all(value[i] < value[j] for j in range(i - n, i)) and all(value[i] <= value[j] for j in range(i + 1, i + n + 1))

        strong = {i for i in range(a, b) if least(i, 5)}
        weak = {i for i in range(a, b) if least(i, 2) and not any(j in strong for j in range(i - 10, i + 11))}
        want |= strong | weak | ({a} if a < b else set())
    assert set(passages.cut_words(h, bounds, 5)) == want


@pytest.mark.parametrize("n", [51, 60, 80])
def test_passages_cover_the_common_run(spark, n):
    """Passages of few distinct words in texts of the same words: found, and covered from end to end."""
    rng = np.random.default_rng(n)
    draw = lambda k: [f"w{v}" for v in rng.integers(0, 300, k)]
    planted = [draw(n) for _ in range(150)]
    docs, spans = {}, {}
    for i in range(300):
        before, after = draw(int(rng.integers(0, 60))), draw(int(rng.integers(0, 60)))
        docs[i] = " ".join(before + planted[i % 150] + after)
        spans[i] = (len(before), len(before) + n)
    got = passages.repeated_passages(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    found = {i: set() for i in range(150, 300)}
    for r in got:
        first = len(docs[r["doc_id"]][: r["start_char"]].split())
        assert r["doc_id"] >= 150 and r["kept_doc_id"] == r["doc_id"] - 150
        found[r["doc_id"]] |= set(range(first, first + r["n_words"]))
    assert sum(bool(w) for w in found.values()) >= 0.98 * 150
    assert sum(len(w & set(range(*spans[i]))) for i, w in found.items()) >= 0.98 * 150 * n
    # words outside the run only in near-equal paragraphs at its ends, or where the texts happen to agree there too
    assert sum(len(w - set(range(*spans[i]))) for i, w in found.items()) <= 0.01 * 150 * n


def test_passages_of_texts_that_share_an_id(spark):
    rng = np.random.default_rng(8)
    shared, other = (" ".join(f"{c}{v}" for v in rng.integers(0, 10**9, 70)) for c in "ab")
    rows = [(1, f"one {shared} two"), (2, f"three {shared} four"), (2, f"five {other} six"), (2, f"five {other} six"), (3, f"seven {other}"), (None, shared)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, version string")
    got = passages.repeated_passages(docs)
    assert sorted((r["doc_id"], r["n_words"], r["kept_doc_id"]) for r in got.collect()) == [(2, 70, 1), (3, 70, 2)]
    left = sorted(str(r["text"]) for r in passages.without_passages(docs.drop("version"), got).collect())
    assert left == sorted([rows[0][1], "three  four", rows[2][1], rows[2][1], "seven ", shared])


def test_passages_awkward(spark):
    got = passages.repeated_passages(awkward(spark)).collect()
    assert {(r["doc_id"], r["kept_doc_id"]) for r in got if r["n_words"] > 1000} == {(8, 7)}
    assert passages.repeated_passages(empty(spark)).count() == 0
    assert len(words(AWKWARD[-1][1])) == 6


def _vector_brute(rows, cosine=0.93):
    good = {}
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = (label, np.array(v, np.float32).astype(float))
    g, n = Groups([r[0] for r in rows if r[0] is not None]), {r[0]: 0 for r in rows}
    keys = sorted(good)
    for k, b in enumerate(keys):
        for a in keys[:k]:
            (la, x), (lb, y) = good[a], good[b]
            if la == lb and len(x) == len(y) and x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= cosine:
                g.link(a, b)
                n[a] += 1
                n[b] += 1
    return {i: (n[i], g.find(i)) for i in n if i is not None}


def test_embeddings_brute_force(spark, tables):
    rng = np.random.default_rng(2)
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in tables("embeddings").collect()]
    for k in range(300):
        i, v, label = rows[k % 40]
        noise = rng.standard_normal(len(v)) * np.linalg.norm(v) / math.sqrt(len(v))
        rows.append((10**6 + k, [float(x) for x in np.array(v) + noise * rng.uniform(0, 0.35)], label))
    rows += [(2 * 10**6 + k, rows[0][1], rows[0][2]) for k in range(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(frame).collect()}
    want = _vector_brute(rows)
    assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in want)
    assert sum(v[0] for v in got.values()) >= 0.97 * sum(v[0] for v in want.values())


def test_embeddings_awkward(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 1), (2, one, 1), (2, one, 1), (3, [2.0, 4.0, 6.0], 1), (4, one, None), (5, one, 2), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1),
        (9, [1.0, None, 3.0], 1), (10, [1.0, float("nan"), 3.0], 1), (11, [1.0, float("inf"), 3.0], 1), (None, one, 1), (12, [1.0, 2.0, 3.0, 0.0], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"item": F.lit(1), "code": F.lit(2), "a": F.lit(3)})
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in embeddings.near_vectors(frame).collect())
    want = [(1, 2, 1), (2, 2, 1), (2, 2, 1), (3, 2, 1)] + [(i, 0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11, None, 12)]
    assert got == sorted((str(i), n, str(c), i is None or i == c) for i, n, c in want)
    assert embeddings.near_vectors(frame.limit(0)).count() == 0


def test_embeddings_join_sides_stay_off_the_driver(spark):
    """A side is broadcast by the size that its shuffle has measured, never by that of its files: here no measured size is small enough, and none may be broadcast."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 64))
    rows = [(k, [float(x) for x in centres[k % 20] + 0.1 * rng.standard_normal(64)], k % 2) for k in range(120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    held = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.maxBroadcastTableSize": "1b"}
    estimated = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(frame).collect()}
        assert {k: spark.conf.get(k) for k in held} == held and spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == estimated != "-1"
    finally:
        for k in held:
            spark.conf.unset(k)
    assert got == _vector_brute([(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows])
    assert sum(n for n, _ in got.values()) == 120 * 5


def test_sample_of_long_vectors_is_held_once():
    rng = np.random.default_rng(6)
    lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
    x = rng.standard_normal((4096, 512))
    column = pa.chunked_array([lists(x[:1000]), lists(rng.standard_normal((3, 8))), lists(x[1000:2000]), *(lists(x[k : k + 524]) for k in range(2000, 4096, 524))])
    tracemalloc.start()
    try:
        got = embeddings.unit_sample(column)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.array_equal(got, x / np.linalg.norm(x, axis=1, keepdims=True))
    assert most < 3 * x.nbytes  # the parts, then the whole of them; indexes of every number took seven times as much
    assert embeddings.unit_sample(pa.chunked_array([], pa.list_(pa.float64()))).shape[0] == 0


@pytest.mark.parametrize("dims", [3, 64, 100])
def test_rotation_keeps_angles(dims):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean, p = embeddings.learn_rotation(x)
    assert p.shape == (dims, 64)
    if dims == 64:
        assert np.allclose(p.T @ p, np.eye(64))
