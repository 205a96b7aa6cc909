"""Grouped and whole-table aggregates."""

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import aggregate as A
from ..operators.quantiles import exact_quantiles
from ..registry import query
from . import standins as S

R = F.round


@query("agg1", "SELECT o_custkey, round(sum(o_totalprice), 4) AS total_spent FROM orders GROUP BY o_custkey")
def group_sum(t):
    return t.orders.groupBy("o_custkey").agg(R(F.sum("o_totalprice"), 4).alias("total_spent")).orderBy(F.desc("total_spent"))


@query(
    "agg2",
    """WITH x AS (SELECT nullif(o_orderpriority, '5-LOW') AS billing FROM orders)
       SELECT billing, count(*) AS n_rows, count(billing) AS n_values FROM x GROUP BY billing""",
)
def count_rows_and_values(t):
    # Grouped by itself, the null group counts no values.
    df = t.orders.select(F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("billing"))
    return df.groupBy("billing").agg(F.count(F.lit(1)).alias("n_rows"), F.count("billing").alias("n_values"))


@query("agg3", "SELECT o_orderpriority, round(avg(o_totalprice / 60000.0), 6) AS avg_minutes FROM orders GROUP BY 1")
def group_average(t):
    return t.orders.groupBy("o_orderpriority").agg(R(F.avg(F.col("o_totalprice") / 60000.0), 6).alias("avg_minutes"))


@query("agg4", "SELECT o_custkey, min(o_totalprice) AS min_total, max(o_totalprice) AS max_total FROM orders GROUP BY 1")
def min_max(t):
    return t.orders.groupBy("o_custkey").agg(F.min("o_totalprice").alias("min_total"), F.max("o_totalprice").alias("max_total"))


@query(
    "agg5",
    """SELECT o_custkey, round(sum(o_totalprice), 4) AS total_spent, round(avg(o_totalprice), 6) AS avg_total FROM orders GROUP BY 1
       HAVING sum(o_totalprice) > 2000000 AND avg(o_totalprice) > 250000""",
)
def having(t):
    return t.sql(
        """SELECT o_custkey, round(sum(o_totalprice), 4) AS total_spent, round(avg(o_totalprice), 6) AS avg_total FROM {orders}
           GROUP BY o_custkey HAVING total_spent > 2000000 AND avg(o_totalprice) > 250000"""
    )


@query(
    "agg6",
    """SELECT o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS num_rows FROM orders GROUP BY 1, 2, 3 HAVING count(*) >= 100""",
)
def several_keys(t):
    return (
        t.orders.groupBy("o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .filter("num_rows >= 100")
    )


@query(
    "agg7",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 4) AS total_by_month FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1""",
)
def month_totals(t):
    day = F.col("o_orderdate")
    year = t.orders.filter((day >= F.to_timestamp_ntz(F.lit("1997-01-01"))) & (day < F.to_timestamp_ntz(F.lit("1998-01-01"))))
    return year.groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(R(F.sum("o_totalprice"), 4).alias("total_by_month"))


@query(
    "agg8",
    """WITH r AS (SELECT hour(ts) AS h, value, event_id % 600 + 60 AS seconds FROM events WHERE ts > '2024-01-03' AND ts < '2024-01-25' AND value > 0)
       SELECT CAST(h AS INTEGER) AS hour_of_day, count(*) AS num_trips, round(3600 * sum(value) / sum(seconds), 6) AS avg_mph FROM r GROUP BY 1""",
)
def ratio_of_sums(t):
    return t.sql(
        """WITH rides AS (SELECT hour(ts) AS hour_of_day, value AS miles, event_id % 600 + 60 AS seconds FROM {events}
             WHERE ts > TIMESTAMP_NTZ '2024-01-03' AND ts < TIMESTAMP_NTZ '2024-01-25' AND value > 0)
           SELECT hour_of_day, count(1) AS num_trips, round(3600 * sum(miles) / sum(seconds), 6) AS avg_mph FROM rides GROUP BY hour_of_day"""
    )


@query(
    "agg9",
    """SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_all, count(DISTINCT nullif(o_orderpriority, '5-LOW')) AS n_skip,
       count(DISTINCT nullif(o_orderpriority, '5-LOW')) + max(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS n_with_null FROM orders GROUP BY 1""",
)
def distinct_counts(t):
    p = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    seen = t.orders.select("o_custkey", "o_orderpriority", p.alias("p")).groupBy("o_custkey", "o_orderpriority", "p").agg(F.lit(1).alias("one"))
    # The values of a key are unique after the first step, so the rest are plain counts.
    return seen.groupBy("o_custkey").agg(
        F.count("o_orderpriority").alias("n_all"),
        F.count("p").alias("n_skip"),
        (F.count("p") + F.max(F.col("p").isNull().cast("int"))).alias("n_with_null"),
    )


@query(
    "agg10",
    """SELECT o_orderpriority, count(o_totalprice) AS n, round(avg(o_totalprice), 6) AS mean, round(median(o_totalprice), 6) AS median,
       round(stddev_samp(o_totalprice), 6) AS std, max(o_totalprice) AS largest FROM orders GROUP BY 1""",
)
def several_stats(t):
    stats = t.orders.groupBy("o_orderpriority").agg(
        F.count("o_totalprice").alias("n"),
        R(F.avg("o_totalprice"), 6).alias("mean"),
        R(F.stddev_samp("o_totalprice"), 6).alias("std"),
        F.max("o_totalprice").alias("largest"),
    )
    middle = exact_quantiles(t.orders, "o_totalprice", {"median": 0.5}, ["o_orderpriority"])
    return stats.join(middle.withColumn("median", R("median", 6)), "o_orderpriority")


@query(
    "agg11",
    """SELECT c_mktsegment, count(*) AS n, round(count(*) / (SELECT count(*) FROM customer), 8) AS share FROM customer GROUP BY 1""",
)
def shares(t):
    counts = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", R(F.col("n") / total, 8))


@query(
    "agg12",
    """SELECT l_returnflag, round(avg(CASE WHEN l_quantity > 10 THEN 1.0 ELSE 0.0 END) * 100, 8) AS pct FROM lineitem GROUP BY 1""",
)
def share_that_passes(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        R(F.avg(F.when(F.col("l_quantity") > 10, 1.0).otherwise(0.0)) * 100, 8).alias("pct")
    )


STATUSES = ["F", "O", "P"]


@query(
    "agg13",
    """SELECT o_orderpriority, """
    + ", ".join(f"round(count(*) FILTER (o_orderstatus = '{s}') / count(*), 8) AS {s}" for s in STATUSES)
    + " FROM orders GROUP BY 1",
)
def cross_table(t):
    # the columns are those that the caller names, and shares are of all rows, so no list of levels is read
    named = [F.count_if(F.col("o_orderstatus") == s).alias(s) for s in STATUSES]
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("_all"), *named)
    return counts.select("o_orderpriority", *[R(F.col(s) / F.col("_all"), 8).alias(s) for s in STATUSES])


@query(
    "agg14",
    """SELECT n_name, """
    + ", ".join(f"round(coalesce(sum(o_totalprice) FILTER (o_orderstatus = '{s}'), 0), 2) AS {s}" for s in STATUSES)
    + """, round(sum(o_totalprice), 2) AS total_revenue FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         GROUP BY 1""",
)
def pivot_sum(t):
    sums = [F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))).alias(s) for s in STATUSES]
    per_customer = t.orders.groupBy("o_custkey").agg(*sums, F.sum("o_totalprice").alias("_all"))
    wide = (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(*[F.coalesce(F.sum(s), F.lit(0.0)).alias(s) for s in STATUSES], F.sum("_all").alias("_all"))
    )
    return wide.select("n_name", *[R(s, 2).alias(s) for s in STATUSES], R("_all", 2).alias("total_revenue")).orderBy(F.desc("total_revenue"))


@query(
    "agg15",
    """WITH s AS (SELECT o_orderpriority AS k, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders GROUP BY 1)
       SELECT k, 'lo' AS metric, lo AS amount FROM s UNION ALL SELECT k, 'hi', hi FROM s""",
)
def wide_to_long(t):
    s = t.orders.groupBy(F.col("o_orderpriority").alias("k")).agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))
    return s.unpivot(["k"], ["lo", "hi"], "metric", "amount")


#: The years of the test tables, for the SQL alone: the query reads the years it finds.
YEARS = range(1995, 2002)


@query(
    "agg15_wide",
    """SELECT o_orderstatus, """
    + ", ".join(f"max(o_totalprice) FILTER (year(o_orderdate) = {y}) AS y{y}" for y in YEARS)
    + " FROM orders GROUP BY 1",
)
def long_to_wide(t):
    y = F.concat(F.lit("y"), F.year("o_orderdate").cast("string"))
    long = t.orders.groupBy("o_orderstatus", y.alias("y")).agg(F.max("o_totalprice").alias("v"))
    return long.groupBy("o_orderstatus").pivot("y", A.levels(long, ["y"])["y"]).agg(F.first("v"))


@query("agg16", "SELECT l_partkey, count(*) AS size FROM lineitem GROUP BY 1")
def group_size(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("size"))


_STAT_SQL = {"mean": "avg({})", "max": "max({})", "min": "min({})", "sum": "coalesce(sum({}), 0)", "count": "count({})"}


def rounds(name):
    """Sums of quotients depend on the row order in the last digits; these outputs are compared rounded."""
    return any(part in name for part in ("RATIO", "RATE", "BURO_BAL", "UTILIZATION", "TE_"))


def stats_sql(prefix, cols, stats=("mean", "max", "min", "sum")):
    out = []
    for c in cols:
        for s in stats:
            name = f"{prefix}_{c}_{s}".upper()
            x = _STAT_SQL[s].format(f"CAST({c} AS DOUBLE)")
            out.append(f'{f"round({x}, 10) + 0" if rounds(name) else x} AS "{name}"')
    return ", ".join(out)


BURO_NUMS = ["AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "CREDIT_DAY_OVERDUE"]


def rounded(df):
    return df.selectExpr(*[f"round(`{n}`, 10) AS `{n}`" if kind == "double" and rounds(n) else f"`{n}`" for n, kind in df.dtypes])


@query("agg17", f"WITH b AS ({S.SQL['bureau']}) SELECT SK_ID_CURR, {stats_sql('BURO', BURO_NUMS)} FROM b GROUP BY 1")
def all_stats(t):
    wide = S.bureau(t).groupBy("SK_ID_CURR").agg(*A.numeric_stats(BURO_NUMS, "BURO"))
    return rounded(wide)


def dummies_sql(column, prefix, values):
    tests = [(f"{prefix}_{v}".upper(), f"{column} = '{v}'") for v in values] + [(f"{prefix}_NAN".upper(), f"{column} IS NULL")]
    counts = [f'count(*) FILTER ({x}) AS "{n}"' for n, x in tests]
    rates = [f'round(count(*) FILTER ({x}) / count(*), 10) AS "{n}_RATE"' for n, x in tests]
    return ", ".join(counts + rates)


@query(
    "agg18",
    f"WITH b AS ({S.SQL['bureau']}) SELECT SK_ID_CURR, {dummies_sql('CREDIT_ACTIVE', 'BURO_ACTIVE', ['Active', 'Closed'])} FROM b GROUP BY 1",
)
def category_counts(t):
    sparse = A.sparse_profile(S.bureau(t), "SK_ID_CURR", ["CREDIT_ACTIVE"])
    return rounded(A.named_levels(sparse, "SK_ID_CURR", {"CREDIT_ACTIVE": ("BURO_ACTIVE", ["Active", "Closed"])}))


@query(
    "agg18_sparse",
    """SELECT o_orderpriority, CAST(o_custkey AS VARCHAR) AS level, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 10) AS rate FROM orders GROUP BY o_orderpriority, o_custkey""",
)
def sparse_counts(t):
    """A category with as many values as there are customers."""
    sparse = A.sparse_profile(t.orders, "o_orderpriority", ["o_custkey"])
    rows = sparse.select("o_orderpriority", "n_rows", F.explode("counts").alias("level", "n"))
    return rows.select("o_orderpriority", "level", "n", F.round(F.col("n") / F.col("n_rows"), 10).alias("rate"))


@query(
    "agg19",
    f"""WITH b AS ({S.SQL['bureau']}), bb AS ({S.SQL['balance']}),
        per AS (SELECT SK_ID_BUREAU, avg(MONTHS_BALANCE) AS m, count(*) FILTER (STATUS IN ('1', '2', '3', '5')) AS bad FROM bb GROUP BY 1)
        SELECT SK_ID_CURR, round(avg(m), 10) AS m_mean, max(m) AS m_max, CAST(coalesce(sum(bad), 0) AS BIGINT) AS bad_sum, max(bad) AS bad_max FROM b
        LEFT JOIN per USING (SK_ID_BUREAU) GROUP BY 1""",
)
def two_level(t):
    bad = F.count_if(F.col("STATUS").isin("1", "2", "3", "5"))
    per = S.balance(t).groupBy("SK_ID_BUREAU").agg(F.avg("MONTHS_BALANCE").alias("m"), bad.alias("bad"))
    roots = S.bureau(t).select("SK_ID_CURR", "SK_ID_BUREAU").join(per, "SK_ID_BUREAU", "left")
    return roots.groupBy("SK_ID_CURR").agg(
        R(F.avg("m"), 10).alias("m_mean"),
        F.max("m").alias("m_max"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_sum"),
        F.max("bad").alias("bad_max"),
    )


WINDOWS = {6: 180, 12: 365, 24: 730}


@query(
    "agg20",
    f"WITH b AS ({S.SQL['bureau']}) SELECT SK_ID_CURR, "
    + ", ".join(
        f"nullif(count(*) FILTER (DAYS_CREDIT >= -{d}), 0) AS n_{m}, "
        f"round(CASE WHEN count(*) FILTER (DAYS_CREDIT >= -{d}) > 0 THEN coalesce(sum(AMT_CREDIT_SUM_DEBT) FILTER (DAYS_CREDIT >= -{d}), 0) END, 5) AS debt_{m}, "
        f"max(AMT_CREDIT_SUM) FILTER (DAYS_CREDIT >= -{d}) AS top_{m}"
        for m, d in WINDOWS.items()
    )
    + " FROM b GROUP BY 1",
)
def recent_windows(t):
    aggs = []
    for m, d in WINDOWS.items():
        recent = F.col("DAYS_CREDIT") >= -d
        aggs += [
            A.within(recent, "count").alias(f"n_{m}"),
            R(A.within(recent, "sum", F.col("AMT_CREDIT_SUM_DEBT")), 5).alias(f"debt_{m}"),
            A.within(recent, "max", F.col("AMT_CREDIT_SUM")).alias(f"top_{m}"),
        ]
    return S.bureau(t).groupBy("SK_ID_CURR").agg(*aggs)


@query(
    "agg21",
    f"""WITH b AS ({S.SQL['bureau']}), a AS (SELECT SK_ID_CURR, """
    + ", ".join(
        f"CASE WHEN count(*) FILTER (CREDIT_ACTIVE = '{v}') > 0 THEN coalesce(sum({c}) FILTER (CREDIT_ACTIVE = '{v}'), 0) END AS {n}_{v}"
        for v in ("Active", "Closed")
        for c, n in (("AMT_CREDIT_SUM_DEBT", "debt"), ("AMT_CREDIT_SUM", "credit"))
    )
    + """ FROM b GROUP BY 1) SELECT SK_ID_CURR, round(debt_Active, 5) AS active_debt, round(debt_Active / nullif(credit_Active, 0), 8) AS active_ratio,
         round(debt_Closed, 5) AS closed_debt, round(debt_Closed / nullif(credit_Closed, 0), 8) AS closed_ratio FROM a""",
)
def status_subsets(t):
    aggs = []
    for v in ("Active", "Closed"):
        cond = F.coalesce(F.col("CREDIT_ACTIVE") == v, F.lit(False))
        aggs.append(A.within(cond, "sum", F.col("AMT_CREDIT_SUM_DEBT")).alias(f"debt_{v}"))
        aggs.append(A.within(cond, "sum", F.col("AMT_CREDIT_SUM")).alias(f"credit_{v}"))
    a = S.bureau(t).groupBy("SK_ID_CURR").agg(*aggs)
    return a.select(
        "SK_ID_CURR",
        R("debt_Active", 5).alias("active_debt"),
        R(C.safe_divide("debt_Active", "credit_Active"), 8).alias("active_ratio"),
        R("debt_Closed", 5).alias("closed_debt"),
        R(C.safe_divide("debt_Closed", "credit_Closed"), 8).alias("closed_ratio"),
    )


@query(
    "agg22",
    f"""WITH i AS ({S.SQL['inst']}), d AS (SELECT *, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS delay FROM i)
        SELECT SK_ID_CURR, round(avg(CASE WHEN delay > 0 THEN 1.0 ELSE 0.0 END), 8) AS late_rate, round(avg(delay) FILTER (delay > 0), 8) AS late_mean,
        CAST(max(delay) FILTER (delay > 0) AS BIGINT) AS late_max FROM d GROUP BY 1""",
)
def flag_rates(t):
    delay = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    late = F.when(delay > 0, delay)
    return S.instalments(t).groupBy("SK_ID_CURR").agg(
        R(F.avg(C.flag(delay > 0)), 8).alias("late_rate"), R(F.avg(late), 8).alias("late_mean"), F.max(late).alias("late_max")
    )


@query(
    "agg23",
    f"""WITH p AS ({S.SQL['prev']}), w AS (SELECT SK_ID_CURR, exp(-greatest(-DAYS_DECISION / 30.0, 0) / 12.0) AS w, CASE WHEN NAME_CONTRACT_STATUS = 'Refused' THEN 1 ELSE 0 END AS f FROM p)
        SELECT SK_ID_CURR, round(sum(f * w) / nullif(sum(w), 0), 8) AS weighted_rate FROM w GROUP BY 1""",
)
def recency_weighted(t):
    w = F.exp(-C.clip(-F.col("DAYS_DECISION") / 30.0, low=0.0) / 12.0)
    refused = C.flag(F.col("NAME_CONTRACT_STATUS") == "Refused")
    return S.previous(t).groupBy("SK_ID_CURR").agg(R(C.safe_divide(F.sum(refused * w), F.sum(w)), 8).alias("weighted_rate"))


@query(
    "agg24",
    f"""WITH c AS ({S.SQL['card']}), u AS (SELECT SK_ID_CURR, MONTHS_BALANCE AS m, AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0) AS u FROM c)
        SELECT SK_ID_CURR, round(avg(u) FILTER (m >= -12) - avg(u) FILTER (m < -12 AND m >= -24), 10) + 0 AS trend FROM u GROUP BY 1""",
)
def trend(t):
    u = C.safe_divide("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL")
    m = F.col("MONTHS_BALANCE")
    now, before = A.within(m >= -12, "mean", u), A.within((m < -12) & (m >= -24), "mean", u)
    return S.card(t).groupBy("SK_ID_CURR").agg(R(now - before, 10).alias("trend"))


@query(
    "agg25",
    f"""WITH p AS ({S.SQL['pos']}), f AS (SELECT SK_ID_CURR, MONTHS_BALANCE AS m, CASE WHEN SK_DPD > 0 THEN 1.0 ELSE 0.0 END AS f FROM p),
        r AS (SELECT SK_ID_CURR, avg(f) FILTER (m >= -6) AS a, avg(f) FILTER (m >= -12) AS b, avg(f) FILTER (m >= -24) AS c FROM f GROUP BY 1)
        SELECT SK_ID_CURR, round(a - b, 10) + 0 AS d1, round(b - c, 10) + 0 AS d2, round((a - b) - (b - c), 10) + 0 AS accel FROM r""",
)
def rate_acceleration(t):
    late = C.flag(F.col("SK_DPD") > 0)
    m = F.col("MONTHS_BALANCE")
    r = S.pos(t).groupBy("SK_ID_CURR").agg(*[A.within(m >= -k, "mean", late).alias(n) for n, k in (("a", 6), ("b", 12), ("c", 24))])
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    return r.select("SK_ID_CURR", R(a - b, 10).alias("d1"), R(b - c, 10).alias("d2"), R((a - b) - (b - c), 10).alias("accel"))


@query(
    "agg26",
    f"""WITH b AS ({S.SQL['bureau']}) SELECT SK_ID_CURR, round(CASE WHEN count(*) FILTER (DAYS_CREDIT >= -365) > 0 THEN coalesce(sum(AMT_CREDIT_SUM_OVERDUE) FILTER (DAYS_CREDIT >= -365), 0) END
        / nullif(CASE WHEN count(*) FILTER (DAYS_CREDIT >= -730) > 0 THEN coalesce(sum(AMT_CREDIT_SUM_OVERDUE) FILTER (DAYS_CREDIT >= -730), 0) END, 0), 8) AS ratio FROM b GROUP BY 1""",
)
def window_ratio(t):
    x, day = F.col("AMT_CREDIT_SUM_OVERDUE"), F.col("DAYS_CREDIT")
    return S.bureau(t).groupBy("SK_ID_CURR").agg(
        R(C.safe_divide(A.within(day >= -365, "sum", x), A.within(day >= -730, "sum", x)), 8).alias("ratio")
    )


@query(
    "agg27",
    f"""WITH p AS ({S.SQL['prev']}), n AS (SELECT SK_ID_CURR, NAME_GOODS_CATEGORY AS v, count(*) AS n FROM p WHERE NAME_GOODS_CATEGORY IS NOT NULL GROUP BY 1, 2)
        SELECT SK_ID_CURR, v AS modal FROM (SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY n DESC, v) AS rn FROM n) WHERE rn = 1""",
)
def modal_value(t):
    return A.most_frequent(S.previous(t), ["SK_ID_CURR"], "NAME_GOODS_CATEGORY", "modal")


@query(
    "agg28",
    """SELECT o_custkey, nullif(o_orderpriority, '5-LOW') AS recent FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
       FROM orders WHERE o_orderpriority <> '5-LOW') WHERE rn = 1""",
)
def recent_value(t):
    df = t.orders.withColumn("p", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")))
    picked = df.groupBy("o_custkey").agg(A.most_recent("p", F.struct("o_orderdate", "o_orderkey")).alias("recent"))
    return picked.filter("recent is not null")


@query(
    "agg29",
    """SELECT round(avg(l_quantity), 6) AS q, round(avg(l_extendedprice), 6) AS p, round(sum(l_tax), 6) AS t, max(l_discount) AS d, round(stddev_pop(l_quantity), 6) AS s FROM lineitem""",
)
def whole_table(t):
    return t.lineitem.agg(
        R(F.avg("l_quantity"), 6).alias("q"),
        R(F.avg("l_extendedprice"), 6).alias("p"),
        R(F.sum("l_tax"), 6).alias("t"),
        F.max("l_discount").alias("d"),
        R(F.stddev_pop("l_quantity"), 6).alias("s"),
    )


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "agg30",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS name, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS lo,
            round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS q2, round(quantile_cont({c}, 0.75), 6) AS q3, max({c}) AS hi FROM lineitem"""
        for c in DESCRIBED
    ),
)
def describe(t):
    # All plain statistics of all columns in one aggregate; only the quantiles take the columns as rows.
    plain = {"n": F.count, "mean": lambda c: R(F.avg(c), 6), "std": lambda c: R(F.stddev_samp(c), 6), "lo": F.min, "hi": F.max}
    wide = t.lineitem.agg(*[F.struct(F.lit(c).alias("name"), *[f(c).alias(k) for k, f in plain.items()]).alias(c) for c in DESCRIBED])
    stats = wide.select(F.inline(F.array(*DESCRIBED)))
    long = t.lineitem.select(*DESCRIBED).unpivot([], DESCRIBED, "name", "v")
    q = exact_quantiles(long, "v", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, ["name"])
    return stats.join(q.select("name", *[R(c, 6).alias(c) for c in ("q1", "q2", "q3")]), "name")


@query(
    "agg31",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(median(l_extendedprice), 6) AS q2, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95
       FROM lineitem GROUP BY 1""",
)
def quantiles(t):
    q = exact_quantiles(t.lineitem, "l_extendedprice", {"q1": 0.25, "q2": 0.5, "p95": 0.95}, ["l_returnflag"])
    return q.select("l_returnflag", *[R(c, 6).alias(c) for c in ("q1", "q2", "p95")])


NULLED = {
    "o_orderpriority": "nullif(o_orderpriority, '5-LOW')",
    "o_orderstatus": "nullif(o_orderstatus, 'P')",
    "o_custkey": "o_custkey",
}


@query(
    "agg32",
    " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) - count({e}) AS n_missing, round((count(*) - count({e})) * 100 / count(*), 6) AS pct FROM orders"
        for n, e in NULLED.items()
    ),
)
def missing_share(t):
    df = t.orders.select(*[F.expr(e).alias(n) for n, e in NULLED.items()])
    one = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in NULLED])
    long = one.unpivot(["n"], list(NULLED), "name", "n_missing")
    return long.select("name", "n_missing", R(F.col("n_missing") * 100 / F.col("n"), 6).alias("pct")).orderBy(F.desc("pct"))


@query(
    "agg33",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(max(k) / sum(k), 8) AS share FROM (SELECT {c} AS v, count(*) AS k FROM lineitem GROUP BY 1)"
        for c in ("l_returnflag", "l_linestatus", "l_quantity", "l_tax")
    )
    + ") WHERE share > 0.1",
)
def dominant_share(t):
    top = A.value_shares(t.lineitem, ["l_returnflag", "l_linestatus", "l_quantity", "l_tax"])
    return top.select("column_name", R(F.col("top") / F.col("n"), 8).alias("share")).filter("share > 0.1")


@query(
    "agg34",
    """WITH s AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY 1)
       SELECT (SELECT o_custkey FROM s ORDER BY v DESC, o_custkey LIMIT 1) AS best, (SELECT o_custkey FROM s ORDER BY v, o_custkey LIMIT 1) AS worst""",
)
def best_row(t):
    s = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("v"))
    return s.agg(
        F.max_by("o_custkey", F.struct("v", -F.col("o_custkey"))).alias("best"),
        F.min_by("o_custkey", F.struct("v", "o_custkey")).alias("worst"),
    )


@query(
    "agg35",
    """WITH m AS (SELECT vec_id AS i, unnest(range(0, 64)) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
       SELECT 'row' AS axis, i AS pos, round(sum(v), 6) AS total FROM m GROUP BY 2 UNION ALL SELECT 'col', j, round(sum(v), 6) FROM m GROUP BY 2""",
)
def matrix_totals(t):
    rows = t.embeddings.select(
        F.lit("row").alias("axis"),
        F.col("vec_id").alias("pos"),
        R(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("total"),
    )
    cells = t.embeddings.select(F.posexplode("embedding").alias("j", "v"))
    cols = cells.groupBy(F.lit("col").alias("axis"), F.col("j").cast("bigint").alias("pos")).agg(
        R(F.sum(F.col("v").cast("double")), 6).alias("total")
    )
    return rows.union(cols)


@query(
    "agg36",
    """SELECT l_suppkey, round(sum(l_discount), 6) AS total_gain, max(l_discount) AS max_gain, count(*) AS n, count(*) FILTER (l_discount > 0) AS n_positive FROM lineitem GROUP BY 1""",
)
def counts_beside_sums(t):
    x = F.col("l_discount")
    return (
        t.lineitem.groupBy("l_suppkey")
        .agg(R(F.sum(x), 6).alias("total_gain"), F.max(x).alias("max_gain"), F.count(x).alias("n"), F.count_if(x > 0).alias("n_positive"))
        .orderBy(F.desc("total_gain"))
    )


@query(
    "agg37",
    """SELECT CASE WHEN starts_with(p_name, 'small') THEN 'small things' WHEN starts_with(p_name, 'red') THEN 'red things' ELSE 'other' END AS bucket,
       count(*) AS n, round(sum(p_retailprice), 4) AS total FROM part GROUP BY 1""",
)
def prefix_buckets(t):
    bucket = A.prefix_bucket("p_name", {"small": "small things", "red": "red things"})
    return t.part.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), R(F.sum("p_retailprice"), 4).alias("total"))


def fold_summary(df, keys, value):
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        R(F.avg(value), 8).alias("mean"),
        R(F.stddev_samp(value), 8).alias("std"),
        R(F.stddev_pop(value), 8).alias("std_pop"),
        R(F.min(value), 8).alias("lo"),
        R(F.max(value), 8).alias("hi"),
    )


@query(
    "agg38",
    """WITH f AS (SELECT o_orderpriority AS model, o_custkey % 5 AS fold, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS score FROM orders GROUP BY 1, 2)
       SELECT model, count(score) AS n, round(avg(score), 8) AS mean, round(stddev_samp(score), 8) AS std, round(stddev_pop(score), 8) AS std_pop,
       round(min(score), 8) AS lo, round(max(score), 8) AS hi FROM f GROUP BY 1""",
)
def fold_summaries(t):
    score = F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0))
    folds = t.orders.groupBy(F.col("o_orderpriority").alias("model"), (F.col("o_custkey") % 5).alias("fold")).agg(score.alias("score"))
    return fold_summary(folds, ["model"], "score")


@query(
    "agg39",
    "SELECT l_returnflag, round(sum(l_quantity * l_discount) / sum(l_quantity), 8) AS weighted_mean FROM lineitem GROUP BY 1",
)
def weighted_mean(t):
    w, x = F.col("l_quantity"), F.col("l_discount")
    return t.lineitem.groupBy("l_returnflag").agg(R(C.safe_divide(F.sum(w * x), F.sum(w)), 8).alias("weighted_mean"))


@query("agg40", "SELECT event_type AS name, count(*) AS num_commits, round(sum(value), 4) AS total FROM events WHERE hour(ts) = 5 GROUP BY 1")
def struct_field_group(t):
    nested = t.events.select(F.struct(F.col("event_type").alias("name"), F.col("ts").alias("date")).alias("committer"), "value")
    return (
        nested.filter(F.hour("committer.date") == 5)
        .groupBy("committer.name")
        .agg(F.count(F.lit(1)).alias("num_commits"), R(F.sum("value"), 4).alias("total"))
    )
