"""Ranks, running values, neighbours and quantiles against brute force, with hot keys and heavy ties."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators.joins import join_hot, multiplicity
from tabulon.operators.ordered import Ordered, cut_points, ordered, ranked, with_peers, with_ranges
from tabulon.operators.quantiles import exact_quantiles, with_quantiles


def make_rows(n=400, seed=1):
    """A third of the rows share one key, and a third share one order value."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None])
        order = 50.0 if rng.random() < 0.34 else float(rng.randint(0, 100))
        rows.append((i, key, order, rng.randint(-5, 20) if rng.random() < 0.9 else None))
    return rows


ROWS = make_rows()


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id long, k string, o double, v int").repartition(3)


def by_key():
    groups = {}
    for r in sorted(ROWS, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups


def test_all_columns(df):
    spec = Ordered(
        order="o", keys=["k"], tie=["id"], row_number="rn",
        running={"s": ("sum", "v"), "c": ("count", "v"), "lo": ("min", "v"), "hi": ("max", "v")},
        total={"t": ("sum", "v")}, lag={"before": "id"}, lead={"after": "id"},
    )
    got = {r.id: r for r in ordered(df, spec).collect()}
    assert len(got) == len(ROWS)
    for rows in by_key().values():
        seen = []
        for i, r in enumerate(rows):
            g = got[r[0]]
            if r[3] is not None:
                seen.append(r[3])
            assert g.rn == i + 1
            assert (g.s, g.c) == (sum(seen) if seen else None, len(seen))
            assert (g.lo, g.hi) == ((min(seen), max(seen)) if seen else (None, None))
            assert g.t == sum(x[3] for x in rows if x[3] is not None)
            assert g.before == (rows[i - 1][0] if i else None)
            assert g.after == (rows[i + 1][0] if i + 1 < len(rows) else None)


def test_lag_keeps_nulls(spark):
    d = spark.createDataFrame([(i, float(i), None if i % 2 else i) for i in range(40)], "id long, o double, v int")
    got = {r.id: r.p for r in ordered(d, Ordered(order="o", lag={"p": "v"})).collect()}
    assert all(got[i] == ((i - 1) if i % 2 else None) for i in range(1, 40)) and got[0] is None


def test_no_window_holds_a_hot_group(df):
    cuts = cut_points(df, "o", 8)
    assert 50.0 in cuts.heavy
    sizes = with_ranges(df, "o", cuts.points).filter("k = 'hot' and o <> 50").groupBy("_range").count()
    assert sizes.agg(F.max("count")).head()[0] < len(ROWS) / 6


def test_rank(df):
    got = {r.id: r for r in ranked(df, "o", ["k"], rank="r", dense_rank="d").collect()}
    for rows in by_key().values():
        values = [r[2] for r in rows]
        for r in rows:
            assert got[r[0]].r == 1 + sum(v < r[2] for v in values)
            assert got[r[0]].d == 1 + len({v for v in values if v < r[2]})


def test_empty_input(df):
    assert ordered(df.filter("id < 0"), Ordered(order="o", keys=["k"], row_number="rn")).count() == 0


def test_quantiles(df):
    q = {r.k: r for r in exact_quantiles(df, "v", {"a": 0.0, "b": 0.25, "m": 0.5, "z": 0.95}, ["k"]).collect()}
    for k, rows in by_key().items():
        v = [r[3] for r in rows if r[3] is not None]
        assert np.allclose([q[k].a, q[k].b, q[k].m, q[k].z], np.quantile(v, [0, 0.25, 0.5, 0.95]))


def test_quantiles_on_rows(df):
    rows = with_quantiles(df, "v", {"m": 0.5}, ["k"]).collect()
    assert len(rows) == len(ROWS) and all(r.m is not None for r in rows)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_hot_equals_join(spark, df, how):
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("zzz", 4)], "k string, w int")
    want = sorted(map(str, df.join(right, "k", how).select("k", "id", "w").collect()))
    got = sorted(map(str, join_hot(df, right, "k", how).select("k", "id", "w").collect()))
    assert got == want


def test_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (1,), (3,)], "k int")
    r = multiplicity(a, b, "k").head()
    assert (r.left_max, r.right_max, r.joined_rows, r.kind) == (2, 3, 6, "N:N")


def test_peers_share_running_values(spark):
    rows = [(i, i % 3 if i % 7 else None, (i * 7) % 5 if i % 11 else None, i % 4) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, g int, o int, v int")
    spec = Ordered(order="o", keys=["g"], running={"n": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v")}, total={"all": ("count", "v")})
    got = {r.id: (r.n, r.s, r.lo, r["all"]) for r in with_peers(df, spec).collect()}
    last = lambda o: (o is None, o)
    for i, g, o, _ in rows:
        mine = [v for _, h, p, v in rows if h == g]
        upto = [v for _, h, p, v in rows if h == g and (p is None) <= (o is None) and (last(p) <= last(o) if p is not None and o is not None else o is None)]
        assert got[i] == (len(upto), sum(upto), min(upto), len(mine)), i


def test_one_exchange_of_rows(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS g", "id % 13 AS o")
    plan = ordered(df, Ordered(order="o", keys=["g"], tie=["id"], row_number="rn"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_group") + plan.count("hashpartitioning(_k__group") <= 3


def test_text_ties_are_cut(spark):
    df = spark.range(3000).selectExpr("id", "1 AS o", "concat('k', lpad(cast(id * 7919 % 3000 AS string), 5, '0')) AS name")
    got = ordered(df, Ordered(order="o", tie=["name"], row_number="rn")).collect()
    assert [r.name for r in sorted(got, key=lambda r: r.rn)] == sorted(r.name for r in got)
    assert sorted(r.rn for r in got) == list(range(1, 3001))
