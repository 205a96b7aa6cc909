"""Sequences, clusters, splits and models against brute force and stated properties."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tabulon.operators import cluster as K
from tabulon.operators import encodings as E
from tabulon.operators import evaluate as V
from tabulon.operators import models as M
from tabulon.operators import outliers as O
from tabulon.operators import sequences as Q
from tabulon.operators import splits as Sp
from tabulon.operators.perceptron import fit_perceptron

SMALL = "/root/testdata/sf0.001"

TAGGED = [
    [("the", "DET"), ("cat", "NOUN"), ("sleeps", "VERB")],
    [("the", "DET"), ("dog", "NOUN"), ("runs", "VERB")],
    [("a", "DET"), ("dog", "NOUN"), ("sleeps", "VERB")],
    [("a", "DET"), ("cat", "NOUN"), ("runs", "VERB")],
    [("dogs", "NOUN"), ("run", "VERB")],
    [("cats", "NOUN"), ("sleep", "VERB")],
]


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(i, j, w, t) for i, s in enumerate(TAGGED) for j, (w, t) in enumerate(s)]
    df = spark.createDataFrame(rows, "s int, n int, w string, t string")
    return Q.hmm_tables(df, "s", "n", "w", "t")


def brute_force(tables, words):
    start, transition, emission, tags = tables
    s = {r.tag: r.p for r in start.collect()}
    a = {(r.prev, r.tag): r.p for r in transition.collect()}
    e = {(r.tag, r.word): r.p for r in emission.collect()}

    def score(path):
        total = math.log(s[path[0]])
        for i, t in enumerate(path):
            total += math.log(e.get((t, words[i]), e[t, None])) + (math.log(a[path[i - 1], t]) if i else 0)
        return total

    return max(itertools.product(tags, repeat=len(words)), key=score)


@pytest.mark.parametrize("block", [2, 3, 1024])
def test_best_tags_equal_brute_force(spark, tables, block):
    texts = ["the dog sleeps", "a cat", "dogs run", "the unseen runs the dog sleeps", "runs", "the a cat sleeps dogs run a"]
    rows = [(i, j, w) for i, x in enumerate(texts) for j, w in enumerate(x.split())]
    got = Q.decode(spark.createDataFrame(rows, "s int, n int, w string"), "s", "n", "w", tables, block=block).collect()
    found = {(r.s, r.n): r.tag for r in got}
    assert len(found) == len(rows)
    for i, x in enumerate(texts):
        words = x.split()
        assert tuple(found[i, j] for j in range(len(words))) == brute_force(tables, words)


def test_decoding_lays_out_few_blocks_at_a_time(spark, tables, monkeypatch):
    """A batch with one long block and many short ones is never filled up as a whole."""
    sizes = [3 * n for n in [1, 2, 3] * 400 + [1024]]
    blocks = pd.Series([np.zeros(n) for n in sizes])
    groups = list(Q._few(blocks, 9))
    assert sorted(np.concatenate(groups).tolist()) == list(range(len(sizes)))
    monkeypatch.setattr(Q, "CELLS", 60)
    for few in Q._few(blocks, 9):
        assert len(few) == 1 or len(few) * max(9, max(sizes[i] for i in few)) <= 60
    assert list(Q._few(pd.Series([], dtype=object), 9)) == []


def test_every_word_is_tagged(spark):
    """Words of several turns are one sequence by (turn, place); a long one goes over blocks and blocks of blocks."""
    rng = random.Random(2)
    said = [(c, t, rng.choice(["x", "y", "z"]), " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 3)))) for c in range(4) for t in range(3)]
    df = spark.createDataFrame(said, "conv int, turn int, tag string, text string")
    rows = Q.word_rows(df, "text", "conv", "turn", "tag")
    tables = Q.hmm_tables(rows, "conv", "turn", "word", "tag", tie=["at"])
    got = Q.decode(rows, "conv", "turn", "word", tables, block=2, tie=["at"]).collect()
    words = {(r.conv, r.turn, r.at): r.word for r in rows.collect()}
    assert len(got) == len(words)
    for c in range(4):
        places = sorted(p for p in words if p[0] == c)
        found = {(r.conv, r.turn, r.at): r.tag for r in got}
        assert tuple(found[p] for p in places) == brute_force(tables, [words[p] for p in places])
    with pytest.raises(ValueError):
        Q.hmm_tables(rows, "conv", "turn", "word", "tag", tie=["at"], max_tags=2)


def test_probabilities_sum_to_one(tables):
    start, transition, emission, tags = tables
    assert math.isclose(sum(r.p for r in start.collect()), 1)
    for t in tags:
        assert math.isclose(sum(r.p for r in transition.filter(F.col("prev") == t).collect()), 1)


def test_stationary_is_unchanged(spark):
    rows = [("s", "s", 0.7), ("s", "c", 0.2), ("s", "r", 0.1), ("c", "s", 0.3), ("c", "c", 0.4), ("c", "r", 0.3), ("r", "s", 0.2), ("r", "c", 0.3), ("r", "r", 0.5)]
    pi = {r.state: r.pi for r in Q.stationary(spark.createDataFrame(rows, "state string, next string, p double")).collect()}
    assert math.isclose(sum(pi.values()), 1, abs_tol=1e-9)
    for s in pi:
        assert abs(sum(pi[a] * p for a, b, p in rows if b == s) - pi[s]) < 1e-9


def test_perplexity_by_hand(spark):
    model = spark.createDataFrame([("the cat",), ("the dog",)], "x string")
    r = Q.perplexity(model, "x", spark.createDataFrame([(1, "the  cat")], "k int, x string"), "k", "x").head()
    v = 4  # the, cat, dog, end mark
    want = [(2 + 0.5) / (2 + 0.5 * v), (1 + 0.5) / (2 + 0.5 * v), (1 + 0.5) / (1 + 0.5 * v)]
    assert math.isclose(r.log_probability, sum(map(math.log, want))) and r.n_pairs == 3
    assert math.isclose(r.perplexity, math.exp(-sum(map(math.log, want)) / 3))


def density_by_hand(points, eps, need):
    near = [[j for j, q in enumerate(points) if math.dist(p, q) <= eps] for p in points]
    core = {i for i, n in enumerate(near) if len(n) >= need}
    group = {}
    for i in core:
        if i in group:
            continue
        todo, group[i] = [i], i
        while todo:
            for j in near[todo.pop()]:
                if j in core and j not in group:
                    group[j] = i
                    todo.append(j)
    border = {i: {group[j] for j in near[i] if j in core} for i in range(len(points)) if i not in core}
    return group, border


@pytest.mark.parametrize("seed", [1, 2])
def test_density_clusters_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    points = [(rng.gauss(cx, 0.25), rng.gauss(cy, 0.25)) for cx, cy in ((0, 0), (1.2, 0), (3, 3)) for _ in range(40)]
    points += [(rng.uniform(-2, 5), rng.uniform(-2, 5)) for _ in range(25)] + [(0.1, 0.1)] * 30
    rows = [(i, x, y) for i, (x, y) in enumerate(points)]
    df = spark.createDataFrame(rows, "i int, x double, y double")
    got = {r.i: r.cluster for r in K.density_clusters(df, "i", ["x", "y"], 0.3, 4).collect()}
    group, border = density_by_hand(points, 0.3, 4)
    assert len(got) == len(points)
    seen = {}
    for i, g in group.items():
        assert got[i] >= 0 and seen.setdefault(g, got[i]) == got[i]
    assert len(set(seen.values())) == len(seen)
    for i, gs in border.items():
        assert got[i] in {seen[g] for g in gs} if gs else got[i] == -1


def test_components(spark):
    nodes = spark.createDataFrame([(i,) for i in range(12)], "node int")
    edges = spark.createDataFrame([(i, i + 1) for i in range(7)] + [(9, 10)], "a int, b int")
    got = {r.node: r.component for r in K.components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(8)) and got[8] == 8 and got[10] == 9 and got[11] == 11


def test_rand_index_bounds(spark):
    same = spark.createDataFrame([(i % 3, (i + 1) % 3) for i in range(30)], "a int, b int")
    assert math.isclose(K.adjusted_rand(same, "a", "b").head()[0], 1.0)


def test_split_shares_are_exact(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = {(r.split, r.y): r["count"] for r in Sp.stratified_split(df, "id", "y").groupBy("split", "y").count().collect()}
    assert got == {("test", 0): 180, ("test", 1): 20, ("valid", 0): 144, ("valid", 1): 16, ("train", 0): 576, ("train", 1): 64}
    a = {r.id: r.split for r in Sp.stratified_split(df, "id", "y").collect()}
    b = {r.id: r.split for r in Sp.stratified_split(df.repartition(7), "id", "y").collect()}
    assert a == b


def test_folds_differ_by_one_row(spark):
    df = spark.range(103).select("id", (F.col("id") < 4).cast("int").alias("y"))
    sizes = Sp.stratified_folds(df, "id", "y", 5).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        n = [r["count"] for r in sizes if r.y == y]
        assert max(n) - min(n) <= 1
    assert sum(r["count"] for r in sizes) == 103


def test_outliers_are_found(spark):
    rng = random.Random(3)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(300)] + [(1000, 9.0, 9.0), (1001, -9.0, 8.0)]
    out = O.isolation_outliers(spark.createDataFrame(rows, "i int, x double, y double"), "i", ["x", "y"], trees=50, sample=64)
    got = {r.i: r for r in out.collect()}
    assert got[1000].outlier and got[1001].outlier and all(0 < r.anomaly <= 1 for r in got.values())
    assert 8 <= sum(r.outlier for r in got.values()) <= 16


def test_forest_is_the_same_under_any_partitioning(spark):
    rng = random.Random(8)
    rows = [(i, rng.gauss(0, 1), rng.choice([1.0, 2.0])) for i in range(900)]
    df = spark.createDataFrame(rows, "i int, x double, y double")
    nodes = [sorted(map(tuple, O.isolation_forest(d, "i", ["x", "y"], trees=7, sample=32).collect())) for d in (df.repartition(5), df.coalesce(1).orderBy("x"))]
    assert nodes[0] == nodes[1] and {n[0] for n in nodes[0]} == set(range(7))
    leaves = Counter(n[0] for n in nodes[0] if n[2] < 0)
    assert all(1 < leaves[t] <= 32 for t in range(7))
    picked = O.tree_samples(df, "i", ["x", "y"], 7, 32, 42)
    draw = F.pmod(F.xxhash64("i", "tree", F.lit(42)), F.lit(1 << 40)) / float(1 << 40)
    everything = df.select("i", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("tree")).withColumn("h", draw).collect()
    got = picked.collect()
    for t in range(7):
        least = {r.i for r in sorted((r for r in everything if r.tree == t), key=lambda r: r.h)[:32]}
        assert least == {r.key for r in sorted((r for r in got if r.tree == t), key=lambda r: r.h)[:32]}
    assert O.isolation_scores(df.limit(0), "i", ["x", "y"]).count() == 0


def test_perceptron_equals_the_loop(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    y = (x @ [1.0, -2.0, 0.5] + 0.3 + rng.normal(size=400) > 0).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "i int, a double, b double, c double, y int")
    order = [r.i for r in df.select("i", F.xxhash64("i", F.lit(42)).alias("h")).orderBy("h", "i").collect()]
    w, b, history = np.zeros(3), 0.0, []
    for _ in range(6):
        wrong = 0
        for i in order:
            s = 1 if y[i] else -1
            if s * (x[i] @ w + b) <= 0:
                w, b, wrong = w + 0.5 * s * x[i], b + 0.5 * s, wrong + 1
        history.append(wrong)
    got = fit_perceptron(df.repartition(3), "i", ["a", "b", "c"], "y", rate=0.5, epochs=6, parts=1)
    assert np.allclose(got.weights, w, atol=1e-9) and math.isclose(got.bias, b, abs_tol=1e-9) and got.mistakes == history


@pytest.mark.parametrize("parts", [1, 5])
def test_perceptron_parts_a_separable_table(spark, parts):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 2))
    y = (x @ [2.0, -1.0] > 0.2).astype(int)
    keep = np.abs(x @ [2.0, -1.0] - 0.2) > 0.3
    rows = [(i, float(a), float(b), int(v)) for i, ((a, b), v, k) in enumerate(zip(x, y, keep)) if k]
    df = spark.createDataFrame([*rows, (9999, None, 1.0, 1)], "i int, a double, b double, y int")
    got = fit_perceptron(df, "i", ["a", "b"], "y", epochs=200, parts=parts)
    assert got.mistakes[-1] == 0
    assert all(r.y == r.p for r in df.filter("a is not null").select("y", got.predict().alias("p")).collect())
    assert fit_perceptron(df.limit(0), "i", ["a", "b"], "y").weights == [0.0, 0.0]


def test_ordered_statistics_by_hand(spark):
    rows = [(i, random.Random(i).choice(["u", "v", None]), f"w{i % 40}", i % 3 % 2 if i % 11 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "i int, c string, d string, y int")
    order = {r.i: r.h for r in df.select("i", F.xxhash64("i", F.lit(17)).alias("h")).collect()}
    got = {r.i: r for r in E.ordered_statistics(df, ["c", "d"], "y", "i").collect()}
    assert len(got) == 300
    for i, c, d, _ in rows:
        for column, level, value in ((1, c, got[i].c_ts), (2, d, got[i].d_ts)):
            before = [r[3] for r in rows if r[column] == level and (order[r[0]], r[0]) < (order[i], i) and r[3] is not None]
            assert math.isclose(value, (sum(before) + 0.5) / (len(before) + 1))
    table = E.target_statistics(df, ["c", "d"], "y")
    new = spark.createDataFrame([(1, "u", "never"), (2, None, "w3")], "i int, c string, d string")
    got = {r.i: r for r in E.apply_statistics(new, ["c", "d"], "i", table).collect()}
    known = [r[3] for r in rows if r[1] is None and r[3] is not None]
    assert got[1].d_ts == 0.5 and math.isclose(got[2].c_ts, (sum(known) + 0.5) / (len(known) + 1))


def test_boosting_on_many_levels(spark):
    """A category of 300 levels that decides the target: no limit on levels, and at least as good as indexed levels."""
    rng = random.Random(9)
    rate = {j: rng.choice([0.1, 0.9]) for j in range(300)}
    rows = [(i, j := rng.randrange(300), rng.gauss(0, 1), int(rng.random() < rate[j])) for i in range(6000)]
    df = spark.createDataFrame([(i, f"c{j}", x, y) for i, j, x, y in rows], "i int, c string, x double, quality int")
    df = M.with_class_weight(df, "quality").withColumn("watch", F.col("i") % 10 == 0)
    train, held = df.filter("i % 4 <> 3"), df.filter("i % 4 = 3")
    own = M.scores(M.boosted_on_categories(train, held, ["x"], ["c"], "quality", "i", "watch", 5), "i", "quality")
    indexed = M.scores(M.boosted_pipeline(["x"], ["c"], "quality", 5, validation="watch").fit(train).transform(held), "i", "quality")
    auc = {n: V.auc_ap(V.score_curve(s.withColumn("g", F.lit(1)), "score", "quality", ["g"]), ["g"]).head().roc_auc for n, s in (("own", own), ("indexed", indexed))}
    assert auc["own"] >= auc["indexed"] - 0.005 and auc["own"] > 0.85


def test_sampled_settings_stay_in_range():
    s = M.sampled_settings({"a": (0.01, 1.0), "b": [1, 2]}, 20)
    assert len(s) == 20 and all(0.01 <= x["a"] <= 1 and x["b"] in (1, 2) for x in s) and s == M.sampled_settings({"a": (0.01, 1.0), "b": [1, 2]}, 20)


def test_models_beat_chance(spark):
    df = spark.range(600).select(
        "id", F.randn(1).alias("a"), F.randn(2).alias("b"), F.when(F.col("id") % 3 == 0, "u").otherwise("v").alias("c")
    )
    df = df.withColumn("quality", (F.col("a") + 0.5 * F.randn(3) > 0.5).cast("int"))
    df = Sp.stratified_folds(df, "id", "quality", 2)
    from tabulon.sources.scratch import durable

    makers = {
        "logistic": lambda: M.logistic_pipeline(["a", "b"], ["c"], "quality", 10),
        "boosted": lambda: M.boosted_pipeline(["a", "b"], ["c"], "quality", 5),
    }
    oof = M.cross_validated(durable(df), "id", "quality", "fold", 2, makers)
    assert oof.count() == 1200 and oof.select("model", "id").distinct().count() == 1200
    assert all(r.mean > 0.85 for r in M.summary(M.fold_metrics(oof, "quality"), ["model"]).collect())


def test_saved_bundle_scores_the_same(spark):
    rows = queries()["src14"](spark, SMALL).collect()
    assert rows and all(r.before == r.after and r.threshold == 0.5 for r in rows)


def test_stacking_gives_one_row_per_document(spark):
    rows = queries()["evl23"](spark, SMALL).collect()
    assert len({r.doc_id for r in rows}) == len(rows) > 0 and all(0 <= r.score <= 1 for r in rows)


def test_batch_scores_pass_the_checks(spark):
    rows = queries()["evl26"](spark, SMALL).collect()
    assert rows and all(0 <= r.TARGET <= 1 for r in rows) and np.std([r.TARGET for r in rows]) > 0
