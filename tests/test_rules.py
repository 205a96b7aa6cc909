"""Null, tie, zero and edge rules on small literal tables."""

import math

import pytest
from pyspark.sql import functions as F

from tabulon.functions import columns as C
from tabulon.operators import aggregate as A
from tabulon.operators import encodings as E
from tabulon.operators import evaluate as V
from tabulon.operators import features as X
from tabulon.operators import preprocess as P
from tabulon.operators import profile as Prof
from tabulon.operators import stats as St
from tabulon.plans.rows import duration_label
from tabulon.sources import tables as Io
from tabulon.sources.scratch import durable, scratch_path


def one(df):
    return df.head()


def test_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (6.0, 3.0)], "a double, b double")
    assert [r.q for r in df.select(C.safe_divide("a", "b").alias("q")).collect()] == [None, None, None, 2.0]


def test_infinity_and_nan_become_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (1.5,), (None,)], "x double")
    assert [r.x for r in C.finite_columns(df).collect()] == [None, None, None, 1.5, None]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-3.0,), (None,), (9.0,)], "x double")
    assert [r.y for r in df.select(C.clip("x", 0.0, 5.0).alias("y")).collect()] == [0.0, None, 5.0]


def test_row_statistics(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    cols = ["a", "b", "c"]
    got = df.select(
        C.row_mean(cols).alias("mean"), C.row_std(cols).alias("std"), C.row_count(cols).alias("n"),
        C.row_total(cols).alias("total"), C.row_total(cols, 1).alias("total1"), C.row_min(cols).alias("lo"),
    ).collect()
    assert got[0].asDict() == {"mean": 2.0, "std": 1.0, "n": 2, "total": 4.0, "total1": 4.0, "lo": 1.0}
    assert got[1].asDict() == {"mean": None, "std": None, "n": 0, "total": 0.0, "total1": None, "lo": None}


def test_duration_edges_take_the_default(spark):
    df = spark.createDataFrame([(2.9,), (3.0,), (5.5,), (6.0,), (6.1,)], "m double")
    assert [r.d for r in df.select(duration_label(F.col("m")).alias("d")).collect()] == ["Short", "false", "Medium", "false", "Long"]


def test_missing_columns_are_tolerated(spark):
    narrow = spark.createDataFrame([(10.0, 0.0)], "AMT_CREDIT double, AMT_INCOME_TOTAL double")
    got = X.row_features(narrow)
    assert set(got.columns) == {"AMT_CREDIT", "AMT_INCOME_TOTAL", "CREDIT_INCOME_RATIO"} and one(got).CREDIT_INCOME_RATIO is None
    assert C.present(narrow, ["x", "AMT_CREDIT", "AMT_CREDIT"]) == ["AMT_CREDIT"]


def test_flags_and_sentinels(spark):
    df = spark.createDataFrame([(365243, None), (-730, 23)], "DAYS_EMPLOYED int, HOUR_APPR_PROCESS_START int")
    a, b = X.row_features(df).collect()
    assert a.EMPLOYED_YEARS is None and a.DAYS_EMPLOYED is None and a.IS_NIGHT_APPLICATION == 0
    assert math.isclose(b.EMPLOYED_YEARS, 730 / 365.25) and b.IS_NIGHT_APPLICATION == 1


def test_windows_without_rows_are_null(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 9, 2.0), ("b", 9, 3.0)], "k string, t int, v double")
    near = F.col("t") < 5
    got = {
        r.k: r
        for r in df.groupBy("k").agg(
            A.within(near, "sum", F.col("v")).alias("s"), A.within(near, "count").alias("n"), A.within(near, "mean", F.col("v")).alias("m")
        ).collect()
    }
    assert (got["a"].s, got["a"].n, got["a"].m) == (0.0, 1, None)
    assert (got["b"].s, got["b"].n, got["b"].m) == (None, None, None)


def test_category_counts_keep_null(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (1, "x"), (2, "y")], "k int, c string")
    wide, found = A.key_profile(df, "k", "P", [], {"c": "P_C"}, record_count="N")
    r = {row.k: row for row in wide.collect()}
    assert found == {"c": ["x", "y"]}
    assert (r[1].P_C_X, r[1].P_C_NAN, r[1].P_C_Y, r[1].N) == (2, 1, 0, 3) and math.isclose(r[1].P_C_X_RATE, 2 / 3)


def test_thousands_of_levels(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("v"), F.col("id")).alias("c"))
    assert A.levels(df, ["c"])["c"] == sorted(f"v{i}" for i in range(5000))
    rows = A.level_profile(df.withColumn("k", F.col("id") % 3), "k", ["c"]).collect()
    assert len(rows) == 5000 and all(r.n == 1 and math.isclose(r.rate, 1 / (1667 if r.k < 2 else 1666)) for r in rows)


def test_mode_and_recent_value(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, None, 9), (2, None, 1)], "k int, v string, d int")
    assert [(r.k, r.m) for r in A.most_frequent(df, ["k"], "v", "m").collect()] == [(1, "a")]
    got = df.groupBy("k").agg(A.most_recent("v", F.col("d")).alias("r")).collect()
    assert {r.k: r.r for r in got} == {1: "a", 2: None}


def test_bureau_without_balance_rows(spark):
    bureau = spark.createDataFrame([(1, 10, "Active", 5.0), (1, 11, None, None)], "SK_ID_CURR int, SK_ID_BUREAU int, CREDIT_ACTIVE string, AMT_CREDIT_SUM double")
    bureau = C.align(
        bureau,
        {"SK_ID_CURR": "int", "SK_ID_BUREAU": "int", "CREDIT_ACTIVE": "string", "CREDIT_TYPE": "string", "CREDIT_CURRENCY": "string"}
        | {c: "double" for c in X.BUREAU.inputs},
    )
    balance = spark.createDataFrame([(10, -1, "5"), (10, -2, None)], "SK_ID_BUREAU int, MONTHS_BALANCE int, STATUS string")
    r = one(X.bureau_features(bureau, balance))
    assert r.BURO_RECORD_COUNT == 2 and r.BURO_AMT_CREDIT_SUM_SUM == 5.0 and r.BURO_AMT_CREDIT_SUM_DEBT_SUM == 0.0
    assert r.BURO_ACTIVE_NAN == 1 and r.BURO_CREDIT_TYPE_NUNIQUE == 0
    assert r.BURO_BAL_BB_BAD_STATUS_COUNT_SUM == 1 and r.BURO_BAL_BB_STATUS_NAN_RATE_MEAN == 0.5


def test_target_encoding_rules(spark):
    rows = [(i, "big" if i < 60 else "rare", i % 2, i % 3) for i in range(70)] + [(70, None, 1, 0)]
    df = spark.createDataFrame(rows, "SK_ID_CURR int, c string, TARGET int, fold int")
    enc = E.fit_encoding(df, "c", "TARGET")
    assert [r.c for r in enc.collect()] == ["big"]
    out = E.apply_encoding(df, "c", enc, E.global_mean(df, "TARGET"), "te").collect()
    mean = sum(r[2] for r in rows) / 71
    assert all(math.isclose(r.te, 0.5 if r.c == "big" else mean) for r in out)


def test_out_of_fold_equals_refitting(spark):
    rows = [(i, f"c{i % 4}", (i * 7) % 5 % 2, i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "SK_ID_CURR int, c string, TARGET int, fold int")
    got = {r.SK_ID_CURR: r.te for r in E.out_of_fold(df, "c", "TARGET", "fold", "te", min_count=35).collect()}
    for i, c, _, f in rows:
        other = [r[2] for r in rows if r[3] != f]
        same = [r[2] for r in rows if r[3] != f and r[1] == c]
        assert math.isclose(got[i], sum(same) / len(same) if len(same) >= 35 else sum(other) / len(other))


def test_auc_counts_ties_half(spark):
    rows = [(0.9, 1), (0.5, 1), (0.5, 0), (0.1, 0), (0.1, 1)]
    curve = V.score_curve(spark.createDataFrame(rows, "p double, y int"), "p", "y")
    r = one(V.auc_ap(curve))
    pairs = [(a, b) for a, y in rows if y for b, z in rows if not z]
    assert math.isclose(r.roc_auc, sum((a > b) + (a == b) / 2 for a, b in pairs) / len(pairs))
    assert math.isclose(r.average_precision, 1 / 3 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5)


def test_confusion_has_all_cells(spark):
    df = spark.createDataFrame([(0.9, 1)], "p double, y int")
    assert sorted(r.n for r in V.confusion(df, "y", V.predicted("p", 0.5)).collect()) == [0, 0, 0, 1]
    m = one(V.class_metrics(V.counts_at(df.filter("p < 0"), "y", V.predicted("p", 0.5))))
    assert m.precision == 0.0 and m.f1 == 0.0


def test_calibration_puts_one_in_the_last_bin(spark):
    df = spark.createDataFrame([(1.0, 1), (0.05, 0)], "p double, y int")
    assert sorted(r.bin for r in V.calibration(df, "p", "y", 5).collect()) == [0, 4]


def test_losses_on_known_values(spark):
    y, p = [0, 0, 1, 1, 1, 0], [0.1, 0.4, 0.8, 0.6, 0.9, 0.2]
    r = one(V.brier_and_log_loss(spark.createDataFrame(list(zip(p, y)), "p double, y int"), "p", "y"))
    assert math.isclose(r.brier, sum((a - b) ** 2 for a, b in zip(p, y)) / 6)
    assert math.isclose(r.log_loss, -sum(math.log(a if b else 1 - a) for a, b in zip(p, y)) / 6)


def test_known_probabilities(spark):
    r = one(
        spark.range(1).select(
            St.binomial_pmf(F.lit(5), F.lit(20), 0.2).alias("b"), St.poisson_cdf(F.lit(3), 2.0).alias("p"),
            St.normal_tail(F.lit(1.96)).alias("z"), St.normal_tail(F.lit(-1.96)).alias("w"), St.exponential_tail(F.lit(5.0), 0.2).alias("e"),
        )
    )
    assert math.isclose(r.b, math.comb(20, 5) * 0.2**5 * 0.8**15, rel_tol=1e-9)
    assert math.isclose(r.p, math.exp(-2) * (1 + 2 + 2 + 4 / 3), rel_tol=1e-9)
    assert abs(r.z - math.erfc(1.96 / math.sqrt(2)) / 2) < 1e-7 and abs(r.w + r.z - 1) < 1e-7
    assert math.isclose(r.e, math.exp(-1))


def test_bootstrap_centre_and_spread(spark):
    df = spark.range(2000).select("id", (F.col("id") % 50).cast("double").alias("x"))
    means = [r.mean for r in St.bootstrap_means(df, "id", "x", 200).collect()]
    centre = sum(means) / len(means)
    spread = math.sqrt(sum((m - centre) ** 2 for m in means) / (len(means) - 1))
    se = math.sqrt(sum((i - 24.5) ** 2 for i in range(50)) / 50) / math.sqrt(2000)
    assert abs(centre - 24.5) < 4 * se / math.sqrt(200) + 0.02 and 0.8 < spread / se < 1.2


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,), (None,)], "x double")
    assert {r.bin: r.n for r in St.histogram(df, "x", 2).collect()} == {0: 1, 1: 2}
    assert St.histogram(df.filter("x = 5"), "x", 2).collect()[0].n == 1


def test_scaler_and_one_hot(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("c", 5.0)], "c string, x double")
    z = [r.x for r in P.fit_scaler(df, ["x"]).transform(df).collect()]
    assert math.isclose(sum(z), 0, abs_tol=1e-12) and math.isclose(sum(v * v for v in z) / 4, 1)
    hot = P.fit_one_hot(df, "c", min_frequency=2)
    got = hot.transform(spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "c string")).collect()
    assert [tuple(r) for r in got] == [(1, 0), (0, 1), (0, 0), (0, 0)]


def test_level_limit(spark):
    df = spark.createDataFrame([(c,) for c in "aaabbcd"], "c string")
    kept = {r.level for r in P.level_map(df, "c", max_levels=3).collect() if r.grouped != "infrequent"}
    assert kept == {"a", "b"}
    assert {r.grouped for r in P.level_map(df, "c", max_levels=4).collect()} == set("abcd")


def test_profile_and_checks(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, None, 0.0)], "id int, c string, v double")
    p = {r.column_name: r for r in Prof.with_issues(Prof.profile(df)).collect()}
    assert p["id"].is_unique and p["c"].n_missing == 1 and math.isclose(p["v"].p_missing, 2 / 3) and p["v"].p_zeros == 1.0
    assert "high missing" in p["v"].issues and "unique id like" in p["id"].issues
    good = spark.createDataFrame([(1, 0.5), (2, 1.0), (3, 0.0)], "id int, s double")
    Prof.accept(Prof.output_checks(good, df, "id", "s", ["id", "s"]))
    for bad in (good.filter("id < 3"), good.withColumn("s", F.col("s") + 0.5), good.withColumnRenamed("s", "t").withColumn("s", F.lit(0.1))):
        with pytest.raises(ValueError):
            Prof.accept(Prof.output_checks(bad, df, "id", "s", ["id", "s"]))


def test_p_value_corrections(spark):
    p = [0.01, 0.04, 0.03, 0.5, 0.5]
    got = {r.k: r for r in St.adjust_p_values(spark.createDataFrame(list(enumerate(p)), "k int, p double"), "p", "k").collect()}
    ranks = sorted(p)
    for k, v in enumerate(p):
        want = min(min(q * 5 / (i + 1) for i, q in enumerate(ranks) if q >= v), 1)
        assert math.isclose(got[k].benjamini_hochberg, want) and math.isclose(got[k].bonferroni, min(v * 5, 1))


def test_guard_cache_and_profile_document(spark, tmp_path):
    big = spark.range(100_000)
    with pytest.raises(ValueError):
        Io.guarded(big, 10)
    assert Io.guarded(big, 10**9) is big
    folder = scratch_path(spark, "t")
    Io.cached_table(spark, folder, "g", "v1", lambda: spark.range(3))
    assert Io.cached_table(spark, folder, "g", "v1", lambda: 1 / 0).count() == 3
    assert Io.cached_table(spark, folder, "g", "v2", lambda: spark.range(4)).count() == 4
    doc = tmp_path / "p.json"
    doc.write_text('{"variables": {\n "a": {"type": "Numeric", "n": 4, "n_missing": 1, "value_counts_without_nan": {"x": 3}},\n "b": {"n": 2}}}')
    rows = {r.variable: r for r in Io.read_profile_json(spark, str(doc)).collect()}
    assert rows["a"].value_counts_without_nan == {"x": 3} and rows["b"].n == 2


def test_durable_keeps_rows_and_types(spark):
    df = spark.range(5).select("id", (F.col("id") * 1.5).alias("x"))
    back = durable(df)
    assert back.dtypes == df.dtypes and sorted(back.collect()) == sorted(df.collect())


def test_first_rows_of_a_large_table(spark):
    skewed = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * F.col("id")).alias("v"), "id")
    skewed = skewed.union(spark.createDataFrame([(None, -1)], "v long, id long"))
    got = [tuple(r) for r in Io.first_rows(skewed, ["v", "id"], 50).collect()]
    want = sorted(((5 if i % 3 == 0 else i * i), i) for i in range(20_000))[:49]
    assert got == [(None, -1), *want]
    far = spark.range(20_000).select((F.col("id") * 1000).alias("v"))
    assert Io._value_reaching(far, "v", 50) < 200_000
    assert Io.first_rows(far.filter("v < 0"), ["v"], 5).count() == 0


def _chain(spark, steps):
    from tabulon.operators.sequences import stationary

    df = spark.createDataFrame(steps, "state string, next string, p double")
    return {r.state: round(r.pi, 6) for r in stationary(df).collect()}


def test_stationary_of_odd_chains(spark):
    assert _chain(spark, [("A", "B", 1.0), ("B", "A", 0.5), ("B", "C", 0.5), ("C", "B", 1.0)]) == {"A": 0.25, "B": 0.5, "C": 0.25}
    assert _chain(spark, [("A", "B", 0.5), ("A", "A", 0.5)]) == {"A": 0.0, "B": 1.0}
    assert _chain(spark, [("A", "B", 1.0), ("B", "B", 1.0)]) == {"A": 0.0, "B": 1.0}


def test_probabilities_of_large_counts(spark):
    import math

    from pyspark.sql import functions as F

    from tabulon.operators import stats

    rows = [(3_000_000_000, 0), (5, 2), (40, 60), (0, 0), (100, 7)]
    got = spark.createDataFrame(rows, "n long, k long").select(
        "n", "k", stats.log_factorial(F.col("n")).alias("f"), stats.poisson_cdf(F.col("k"), 7.5).alias("c"), stats.poisson_cdf(F.col("n"), 7.5).alias("d")
    ).collect()
    for r in got:
        assert math.isclose(r.f, math.lgamma(r.n + 1), rel_tol=1e-12, abs_tol=1e-9)
        want = sum(math.exp(i * math.log(7.5) - 7.5 - math.lgamma(i + 1)) for i in range(min(r.k, 200) + 1))
        assert math.isclose(r.c, want, abs_tol=1e-10)
        assert r.n < 100 or math.isclose(r.d, 1.0, abs_tol=1e-10)


def test_any_number_of_levels(spark):
    from tabulon.operators import aggregate as A
    from tabulon.operators import preprocess as P

    df = spark.range(10_000).selectExpr("id % 10 AS k", "concat('v', id % 5000) AS c")
    long = A.level_profile(df, "k", ["c"])
    assert long.count() == 5000 and long.filter("n <> 2 or abs(rate - 0.002) > 1e-9").count() == 0
    assert len(A.levels(df, ["c"])["c"]) == 5000
    assert len(P.fit_one_hot(df, "c").kept) == 5000


def test_bootstrap_state_equals_the_rows_drawn_one_by_one(spark):
    """The one-pass state draws what xxhash64(key, replicate, seed) says, row by row, for text and number keys."""
    df = spark.range(500).select("id", F.concat(F.lit("k"), "id").alias("name"), F.when(F.col("id") % 7 > 0, (F.col("id") % 50).cast("double")).alias("x"))
    for key in ("id", "name"):
        rep = df.filter("x is not null").select(key, "x", F.explode(F.sequence(F.lit(1), F.lit(20))).alias("replicate"))
        u = (F.pmod(F.xxhash64(key, "replicate", F.lit(42)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
        w = sum(((u > c).cast("int") for c in St.poisson_steps()), F.lit(0))
        want = {r.replicate: (r.w, r.wx) for r in rep.groupBy("replicate").agg(F.sum(w).alias("w"), F.sum(w * F.col("x")).alias("wx")).collect()}
        got = {r.replicate: (r.w, r.wx) for r in St.bootstrap_state(df.repartition(5), key, "x", 20).collect()}
        assert got == want
    assert St.bootstrap_means(df.limit(0), "id", "x", 5).count() == 0
