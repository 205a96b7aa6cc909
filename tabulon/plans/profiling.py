"""Column profiles, issue flags and output checks."""

from pyspark.sql import functions as F

from ..operators import profile as P
from ..registry import query

R = F.round
NULLED = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "nullif(o_custkey % 10, 0)",
    "o_totalprice": "CASE WHEN o_totalprice > 250000 THEN floor(o_totalprice) * 1e0 END",
    "o_orderstatus": "nullif(o_orderstatus, 'P')",
    "o_clerk": "CASE WHEN o_orderkey % 4000 = 0 THEN 'b' ELSE 'a' END",
}
TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderstatus": "string", "o_clerk": "string"}
SKEW = "(avg(pow(x - mu, 3)) / pow(avg(pow(x - mu, 2)), 1.5)) * sqrt(count(x) * (count(x) - 1.0)) / (count(x) - 2)"


def one_column(n, e):
    number = TYPES[n] != "string"
    x = f"CAST({e} AS DOUBLE)" if number else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{n}' AS column_name, '{TYPES[n]}' AS type, count(*) AS n, count(*) - count(v) AS n_missing, count(DISTINCT v) AS n_distinct, min(x) AS lo, max(x) AS hi, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std,
      round({SKEW}, 6) + 0 AS skewness, round(avg(CASE WHEN x = 0 THEN 1.0 WHEN x IS NOT NULL THEN 0.0 END), 8) AS p_zeros,
      (SELECT max(k) FROM (SELECT {e} AS v, count(*) AS k FROM orders GROUP BY 1)) AS top FROM (SELECT {e} AS v, {x} AS x, (SELECT avg({x}) FROM orders) AS mu FROM orders)"""


PROFILE = f"""pr AS (SELECT column_name, type, n, n_missing, n_missing / n AS p_missing, n_distinct, n_distinct / n AS p_distinct, n_distinct = n - n_missing AS is_unique, lo, hi, mean, std, skewness, p_zeros, top / n AS top_share
  FROM ({' UNION ALL '.join(one_column(n, e) for n, e in NULLED.items())}))"""


def nulled(t):
    return t.orders.selectExpr(*[f"{e} AS {n}" for n, e in NULLED.items()])


@query(
    "prf1",
    f"""WITH {PROFILE} SELECT column_name, type, n, n_missing, round(p_missing, 8) AS p_missing, n_distinct, round(p_distinct, 8) AS p_distinct, is_unique, lo, hi, mean, std, skewness, p_zeros, round(top_share, 8) AS top_share FROM pr""",
)
def table_profile(t):
    p = P.profile(nulled(t)).withColumnsRenamed({"min": "lo", "max": "hi"})
    digits = {"p_missing": 8, "p_distinct": 8, "mean": 6, "std": 6, "skewness": 6, "p_zeros": 8, "top_share": 8}
    return p.withColumns({c: R(c, d) for c, d in digits.items()})


@query("prf1_approx")
def table_profile_approximate(t):
    return P.profile(t.lineitem, approximate=True)


WORDS = [("o_orderkey", "number of the order"), ("o_orderstatus", "state of the order"), ("o_totalprice", "amount")]


@query(
    "prf2",
    f"""WITH {PROFILE} SELECT column_name, type, round(p_missing * 100, 6) AS missing_pct, n_distinct, description FROM pr
        LEFT JOIN (VALUES {', '.join(f"('{a}', '{b}')" for a, b in WORDS)}) d(column_name, description) USING (column_name)""",
)
def column_overview(t):
    words = t.spark.createDataFrame(WORDS, "column_name string, description string")
    p = P.profile(nulled(t)).join(words, "column_name", "left")
    return p.select("column_name", "type", R(F.col("p_missing") * 100, 6).alias("missing_pct"), "n_distinct", "description")


@query(
    "prf3",
    f"""WITH {PROFILE} SELECT 'orders' AS table_name, column_name, round(p_missing, 8) AS p_missing, row_number() OVER (ORDER BY p_missing DESC, column_name)::INTEGER AS place FROM pr QUALIFY place <= 3""",
)
def top_missing(t):
    p = P.profile(nulled(t)).withColumn("table_name", F.lit("orders"))
    return P.top_columns(p, "table_name", "p_missing", 3).select("table_name", "column_name", R("p_missing", 8).alias("p_missing"), "place")


@query(
    "prf4",
    f"""WITH {PROFILE}, i AS (SELECT column_name, list_filter([CASE WHEN p_missing >= 0.5 THEN 'high missing' WHEN p_missing >= 0.25 THEN 'moderate missing' END, CASE WHEN top_share >= 0.995 THEN 'near constant' END,
        CASE WHEN is_unique OR p_distinct >= 0.995 THEN 'unique id like' END, CASE WHEN abs(skewness) >= 10 THEN 'extreme skew' END, CASE WHEN column_name = 'o_custkey' THEN 'known sentinel' END], lambda x: x IS NOT NULL) AS f FROM pr)
        SELECT column_name, CAST(len(f) AS INTEGER) AS issue_count, array_to_string(f, '; ') AS issues FROM i""",
)
def issue_flags(t):
    return P.with_issues(P.profile(nulled(t)), {"o_custkey": "0"}).select("column_name", "issue_count", "issues")


@query(
    "prf5",
    """WITH s AS (SELECT c_custkey, c_acctbal / 9000.0 AS score FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT -1, 0.5)
       SELECT (SELECT count(*) FROM s WHERE NOT coalesce(score BETWEEN 0 AND 1, false)) AS outside_range, abs((SELECT count(*) FROM s) - (SELECT count(*) FROM customer)) AS row_difference, CAST(0 AS BIGINT) AS wrong_columns,
       (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM s)) AS missing_ids, (SELECT count(*) FROM s WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)) AS unknown_ids""",
)
def checks(t):
    scores = t.customer.filter("c_mktsegment <> 'BUILDING'").select("c_custkey", (F.col("c_acctbal") / 9000.0).alias("score"))
    stray = t.spark.createDataFrame([(-1, 0.5)], "c_custkey long, score double")
    return P.output_checks(scores.union(stray), t.customer, "c_custkey", "score", ["c_custkey", "score"])


@query(
    "prf6",
    """SELECT CASE WHEN h < 64 THEN 'train' WHEN h < 80 THEN 'valid' ELSE 'test' END AS split, count(*) AS n, round(avg(quality), 10) AS positive_rate
       FROM (SELECT quality, (doc_id % 2147483647) * 48271 % 2147483647 % 100 AS h FROM labels) GROUP BY 1""",
)
def balance_per_split(t):
    h = (F.col("doc_id") % 2147483647) * 48271 % 2147483647 % 100
    split = F.when(h < 64, "train").when(h < 80, "valid").otherwise("test")
    out = P.class_balance(t.labels.withColumn("split", split), "split", "quality")
    return out.withColumn("positive_rate", R("positive_rate", 10))
