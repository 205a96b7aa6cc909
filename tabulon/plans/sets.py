"""Set operations and function hooks."""

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..registry import query

DAY = "ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-02'"


@query(
    "set1",
    f"""SELECT user_id FROM events WHERE event_type = 'signup' AND {DAY} UNION SELECT user_id FROM events WHERE event_type = 'purchase' AND {DAY}""",
)
def union_distinct(t):
    day = t.events.filter("ts >= TIMESTAMP_NTZ '2024-01-01' AND ts < TIMESTAMP_NTZ '2024-01-02'")
    a = day.filter("event_type = 'signup'").select("user_id")
    return a.union(day.filter("event_type = 'purchase'").select("user_id")).distinct()


@query("set2", "SELECT c_custkey AS k, c_acctbal AS amount FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def union_by_position(t):
    return t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("amount")).union(
        t.supplier.select("s_suppkey", "s_acctbal")
    )


@query(
    "set3",
    """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier
       UNION ALL SELECT 'Unknown', 0.0, 'NONE'""",
)
def stack_by_name(t):
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    extra = t.spark.createDataFrame([("Unknown", 0.0, "NONE")], "name string, balance double, segment string")
    return a.unionByName(b, allowMissingColumns=True).unionByName(extra)


@query("set4", "SELECT count(*) AS n_stacked, count(*) AS n_all, true AS same FROM orders WHERE o_orderdate IS NOT NULL")
def split_and_stack(t):
    cut = F.to_timestamp_ntz(F.lit("1998-01-01"))
    before, after = t.orders.filter(F.col("o_orderdate") < cut), t.orders.filter(F.col("o_orderdate") >= cut)
    whole = t.orders.agg(F.count("*")).scalar()
    return before.union(after).agg(F.count("*").alias("n_stacked")).select(
        "n_stacked", whole.alias("n_all"), (F.col("n_stacked") == whole).alias("same")
    )


@query("set5", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def id_difference(t):
    ids = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey").distinct().join(ids, "o_orderkey", "left_anti")


# Functions handed to Python workers are defined inside the queries, so they travel with the job
# and the workers need no copy of this package.


@query("udf1", "SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS by_udf, CAST(length(p_name) AS INTEGER) AS built_in, lower(p_name) AS low FROM part")
def per_value(t):
    @F.pandas_udf(T.IntegerType())
    def text_length(s: pd.Series) -> pd.Series:
        return s.str.len().astype("int32")

    return t.part.select(
        "p_partkey", text_length("p_name").alias("by_udf"), F.length("p_name").alias("built_in"), F.lower("p_name").alias("low")
    )


@query(
    "udf2",
    """SELECT l_orderkey, l_partkey, l_suppkey, least(l_quantity, l_discount, l_tax) AS by_udf, least(l_quantity, l_discount, l_tax) AS built_in, CAST(3 AS INTEGER) AS width FROM lineitem""",
)
def along_rows(t):
    @F.pandas_udf(T.DoubleType())
    def row_minimum(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return a.where(a < b, b).where(lambda m: m < c, c)

    cols = ["l_quantity", "l_discount", "l_tax"]
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", row_minimum(*cols).alias("by_udf"), F.least(*cols).alias("built_in"), F.size(F.array(*cols)).alias("width")
    )


@query(
    "udf3",
    """SELECT l_returnflag, round(avg(CASE WHEN l_quantity > 10 THEN 1.0 ELSE 0.0 END) * 100, 8) AS by_udf,
       round(avg(CASE WHEN l_quantity > 10 THEN 1.0 ELSE 0.0 END) * 100, 8) AS built_in FROM lineitem GROUP BY 1""",
)
def user_aggregate(t):
    def partial_over_ten(batches):
        """Rows and hits per group of one batch. A built-in sum merges them, so no group sits in one task."""
        for pdf in batches:
            g = pdf.assign(hit=(pdf["l_quantity"] > 10).astype("int64")).groupby("l_returnflag")["hit"].agg(["sum", "count"])
            yield g.reset_index().rename(columns={"sum": "hits", "count": "n"})

    df = t.lineitem.select("l_returnflag", "l_quantity")
    parts = df.mapInPandas(partial_over_ten, "l_returnflag string, hits bigint, n bigint")
    udf = parts.groupBy("l_returnflag").agg(F.round(F.sum("hits") / F.sum("n") * 100, 8).alias("by_udf"))
    built = df.groupBy("l_returnflag").agg(
        F.round(F.avg(F.when(F.col("l_quantity") > 10, 1.0).otherwise(0.0)) * 100, 8).alias("built_in")
    )
    return udf.join(built, "l_returnflag")


@query(
    "udf4",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 5""",
)
def rows_per_group(t):
    # The general hook for a function per group: rows sorted by key stream through it, and only the
    # group in hand is remembered. The first pass leaves at most five rows per key and task.
    def head_of_each_key(batches):
        last, seen = None, 0
        for pdf in batches:
            if pdf.empty:
                continue
            place = pdf.groupby("o_custkey").cumcount()
            place += (pdf["o_custkey"] == last) * seen
            yield pdf[place < 5]
            last, seen = pdf["o_custkey"].iloc[-1], place.iloc[-1] + 1

    order = ["o_custkey", F.desc("o_totalprice"), "o_orderkey"]
    df = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    per_task = df.sortWithinPartitions(*order).mapInPandas(head_of_each_key, df.schema)
    return per_task.repartition("o_custkey").sortWithinPartitions(*order).mapInPandas(head_of_each_key, df.schema)
