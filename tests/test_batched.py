"""Batched fits, exact silhouettes, footer estimates and sparse profiles against separate computations."""

import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tabulon.operators import aggregate as A
from tabulon.operators import batched as B
from tabulon.operators import cluster as K
from tabulon.operators import models as M
from tabulon.sources import tables as Io


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 3)) * [1.0, 50.0, 0.01] + [0, 1e4, 3]
    c = rng.choice(["u", "v", "w"], 900)
    y = (x[:, 0] + (x[:, 1] - 1e4) / 50 + (c == "u") + rng.normal(size=900) > 0.8).astype(int)
    data = [(i, *map(float, r), str(k), int(v), i % 3, i // 7 % 2) for i, (r, k, v) in enumerate(zip(x, c, y))]
    return spark.createDataFrame(data, "i int, a double, b double, c double, k string, y int, f int, g int").repartition(5).cache()


def test_batched_fits_equal_separate_fits(spark, rows):
    """Scores of all problems at once against one fit of the engine's own learner per problem."""
    sets = {"all": (["a", "b", "c"], ["k"]), "two": (["a", "b"], []), "one": (["c"], ["k"])}
    problems = B.fold_problems(sets, "f", 3) + B.fold_problems({"other": (["a", "c"], [])}, "g", 2)
    got = {(r.model, r.fold, r.i): r.score for r in B.cross_scores(rows, "i", "y", problems, reg=0.02).collect()}
    assert len(got) == 900 * 4
    for p in problems:
        train = M.with_class_weight(rows.filter(F.col(p.fold) != p.held), "y")
        learner = LogisticRegression(labelCol="y", weightCol="weight", regParam=0.02, standardization=False, maxIter=500, tol=1e-14)
        model = M.pipeline(list(p.numerics), list(p.categories), learner).fit(train)
        held = M.scores(model.transform(rows.filter(F.col(p.fold) == p.held)), "i").collect()
        assert max(abs(got[p.name, p.held, r.i] - r.score) for r in held) < 1e-6


def test_batched_coefficients_solve_the_problem(spark, rows):
    """The gradient of every problem is zero at its coefficients; one pass a step, however many problems there are."""
    problems = B.fold_problems({"all": (["a", "b", "c"], [])}, "f", 3)
    design, betas = B.fit_logistics(rows, problems, "y", reg=0.05)
    data = rows.toPandas()
    for p, beta in zip(problems, betas):
        t = data[data.f != p.held]
        x = t[["a", "b", "c"]].to_numpy()
        x = np.column_stack([x / x.std(axis=0, ddof=1), np.ones(len(t))])
        w = np.where(t.y > 0, len(t) / (2 * t.y.sum()), len(t) / (2 * (1 - t.y).sum()))
        gradient = x.T @ (w * (1 / (1 + np.exp(-(x @ beta))) - t.y)) / len(t) + np.append(0.05 * beta[:-1], 0)
        assert np.abs(gradient).max() < 1e-8


def test_batched_nulls_and_unseen_levels(spark, rows):
    holes = rows.select("i", F.when(F.col("i") % 5 > 0, F.col("a")).alias("a"), F.when(F.col("f") == 0, "only here").when(F.col("i") % 4 > 0, F.col("k")).alias("k"), "y", "f")
    got = B.cross_scores(holes, "i", "y", B.fold_problems({"m": (["a"], ["k"])}, "f", 3)).collect()
    assert len(got) == 900 and all(0 < r.score < 1 for r in got)


@pytest.mark.parametrize("block", [7, 256])
def test_silhouettes_equal_brute_force(spark, block):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(40, 4)) + m for m in ([0] * 4, [3] * 4, [9, 0, 0, 0], [0, 30, 0, 0])] + [np.full((1, 4), 50.0), np.zeros((6, 4))])
    c = np.repeat([0, 1, 2, 3, 4, 5], [40, 40, 40, 40, 1, 6])
    df = spark.createDataFrame([(i, list(map(float, v)), int(k)) for i, (v, k) in enumerate(zip(x, c))], "i int, x array<double>, c int")
    got = {r.i: r for r in K.silhouettes(df, "i", "x", "c", block).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for i in range(len(x)):
        means = {k: d[i, c == k].sum() / max((c == k).sum() - (k == c[i]), 1) for k in range(6)}
        b = min(v for k, v in means.items() if k != c[i])
        alone = (c == c[i]).sum() == 1
        want = 0.0 if alone else (b - means[c[i]]) / max(b, means[c[i]])
        assert abs(got[i].silhouette - want) < 1e-9 and abs(got[i].b - b) < 1e-9
    assert K.silhouettes(df.filter("c = 0"), "i", "x", "c").filter("silhouette is not null").count() == 0
    assert K.silhouettes(df.limit(0), "i", "x", "c").count() == 0


def test_distance_sums_equal_differences():
    """Close points far from the origin, copies, and tiles that are not full."""
    rng = np.random.default_rng(9)
    a = np.concatenate([rng.normal(size=(30, 5)), 1e5 + rng.normal(size=(30, 5)) * 1e-3, np.full((5, 5), 7.0)])
    b = np.concatenate([a[::2], rng.normal(size=(11, 5))])
    want = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2)).sum(axis=1)
    assert np.allclose(K._distance_sums(a, b, tile=16), want, rtol=1e-11, atol=0)
    copies = np.full((4, 5), 1e6 / 3)
    assert not K._distance_sums(copies, copies).any()


def test_silhouettes_spread_a_cluster_over_tasks(spark):
    """Points against points are dealt by cluster and part; by cluster alone a few tasks had all the work."""
    df = spark.range(3000).select("id", F.array((F.col("id") % 97).cast("double"), F.rand(3)).alias("x"), (F.col("id") % 2).cast("int").alias("c"))
    rows = K.silhouettes(df, "id", "x", "c")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.split("\n") if "hashpartitioning(i#" in line and "REPARTITION" in line]
    assert dealt and all(", part#" in line for line in dealt)
    assert not any("Join [i#" in line for line in plan.split("\n"))
    assert rows.count() == 3000


def test_scan_estimate_follows_columns_and_ranges(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    n = 4000
    table = pa.table({"k": list(range(n)), "v": [random.Random(i).random() for i in range(n)], "s": [f"text {i:06d}" for i in range(n)], "l": [[i, i] for i in range(n)]})
    pq.write_table(table, path, row_group_size=1000)
    df = spark.read.parquet(path)
    footers = Io.parquet_footers(df).cache()
    meta = pq.ParquetFile(path).metadata
    sizes = {c: [sum(meta.row_group(g).column(j).total_compressed_size for j in range(meta.num_columns) if meta.schema.column(j).path.split(".")[0] == c) for g in range(4)] for c in "kvsl"}
    ask = lambda *a: tuple(Io.scan_estimate(footers, *a).head())
    assert ask() == (sum(map(sum, sizes.values())), 4, n)
    assert ask(["k"]) == (sum(sizes["k"]), 4, n) and ask(["k", "l"]) == (sum(sizes["k"]) + sum(sizes["l"]), 4, n)
    assert ask(["v"], {"k": (1500, 2100)}) == (sum(sizes["v"][1:3]), 2, 2000)
    assert ask(["v"], {"k": (None, 999), "s": ("text 0000", None)}) == (sizes["v"][0], 1, 1000)
    assert ask(["v"], {"s": ("text 003500", None)}) == (sizes["v"][3], 1, 1000)
    assert ask(["v"], {"k": (9999, None)}) == (0, 0, 0)
    assert Io.guarded_scan(df, sum(sizes["k"]), ["k"]).columns == ["k"]
    with pytest.raises(ValueError):
        Io.guarded_scan(df, sum(sizes["k"]) - 1, ["k"])


def test_sparse_profile_of_many_levels(spark):
    """A hundred thousand values: no list of them is made, and named ones become columns as in the wide form."""
    df = spark.range(150_000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 1000 > 0, F.concat(F.lit("v"), F.col("id") % 100_000)).alias("c"))
    sparse = A.sparse_profile(df, "k", ["c"])
    rows = {r.k: r for r in sparse.select("k", F.size("counts").alias("s"), "n_null", "n_rows", F.col("counts")["v7"].alias("v7")).collect()}
    want = df.groupBy("k").agg(F.count_distinct("c").alias("s"), F.count_if(F.col("c").isNull()).alias("n"), F.count_if(F.col("c") == "v7").alias("v7")).collect()
    assert {k: (r.s, r.n_null, r.n_rows, r.v7 or 0) for k, r in rows.items()} == {r.k: (r.s, r.n, 50_000, r.v7) for r in want}
    few = df.filter("c in ('v7', 'v8') or c is null")
    wide, _ = A.key_profile(few, "k", "P", [], {"c": "C"})
    named = A.named_levels(A.sparse_profile(few, "k", ["c"]), "k", {"c": ("C", ["v7", "v8"])})
    a, b = ({r.k: r.asDict() for r in d.collect()} for d in (wide, named))
    assert a.keys() == b.keys() and all(math.isclose(a[k][c], b[k][c]) for k in a for c in wide.columns if c != "k")
