"""Reading, writing, catalog and caching."""

from functools import reduce

from pyspark.sql import functions as F

from ..operators import models as M
from ..registry import query
from ..sources import tables as Io
from ..sources.scratch import durable, scratch_path

SUPPLIER = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"


@query("src1", "SELECT * FROM supplier")
def delimited_scan(t):
    path = scratch_path(t.spark, "supplier-csv")
    t.supplier.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return Io.read_delimited(t.spark, path, SUPPLIER, encoding="ISO-8859-1")


@query("src2", "SELECT l_orderkey, l_quantity, l_discount, l_shipdate FROM lineitem")
def column_subset(t):
    return t.lineitem.select("l_orderkey", "l_quantity", "l_discount", "l_shipdate")


@query(
    "src3",
    "SELECT count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi, count(DISTINCT o_custkey) AS n_customers FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 200000)",
)
def first_rows_sample(t):
    sample = Io.first_rows(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 200_000)
    return sample.agg(
        F.count("*").alias("n"),
        F.min("o_totalprice").alias("lo"),
        F.max("o_totalprice").alias("hi"),
        F.count_distinct("o_custkey").alias("n_customers"),
    )


@query("src4", "SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def qualified_name(t):
    t.orders.createOrReplaceGlobalTempView("tabulon_orders")
    return t.spark.sql("SELECT DISTINCT o_orderpriority FROM `global_temp`.`tabulon_orders` WHERE o_orderstatus = 'F'")


@query(
    "src5",
    "SELECT l_orderkey, l_quantity, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = 'PROMO'",
)
def extract(t):
    joined = t.sql(
        "SELECT l_orderkey, l_quantity, p_name, p_brand FROM {lineitem} JOIN {part} ON l_partkey = p_partkey WHERE p_type = :kind",
        kind="PROMO",
    )
    path = Io.write_delimited(joined, scratch_path(t.spark, "extract"))
    return Io.read_delimited(t.spark, path, joined.schema)


@query("src6")
def table_schemas(t):
    """Every table of the data set's folder with its columns and a preview value of each."""
    frames = {n: getattr(t, n) for n in Io.list_tables(t.spark, t.path)}
    previews = {n: Io.examples(df) for n, df in frames.items()}
    rows = [(n, c, kind, null, previews[n][c]) for n, c, kind, null in Io.describe_tables(frames)]
    return t.spark.createDataFrame(rows, "table_name string, column_name string, type string, nullable boolean, example string")


@query("src7")
def scan_guard(t):
    """What scans of all columns, of two columns and of two columns in a range of keys would read, from the footers."""
    asked = {"lineitem": ["l_orderkey", "l_quantity"], "orders": ["o_orderkey", "o_totalprice"], "customer": ["c_custkey", "c_acctbal"]}
    out = None
    for name, columns in asked.items():
        footers = durable(Io.parquet_footers(getattr(t, name)))
        scans = {"all": (None, None), "columns": (columns, None), "range": (columns, {columns[0]: (None, 0)})}
        for scan, (wanted, between) in scans.items():
            row = Io.scan_estimate(footers, wanted, between).select(F.lit(name).alias("table_name"), F.lit(scan).alias("scan"), "*")
            out = row if out is None else out.union(row)
    return out.withColumn("allowed", F.col("bytes") <= 1_000_000)


FOOTED = {"lineitem": "l_orderkey", "orders": "o_custkey", "customer": "c_custkey", "part": "p_size"}


@query(
    "src7_rows",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM {n}" for n, c in FOOTED.items()),
)
def footer_rows(t):
    """Row counts and bounds of a column from the footers alone, against the rows themselves."""
    parts = []
    for name, column in FOOTED.items():
        chunks = Io.parquet_footers(getattr(t, name)).filter(F.col("column") == column)
        parts.append(chunks.agg(F.lit(name).alias("table_name"), F.sum("rows").alias("n_rows"), F.min("low").alias("low"), F.max("high").alias("high")))
    return reduce(lambda a, b: a.union(b), parts)


@query(
    "src8",
    """SELECT meaning, count(*) AS n FROM orders JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) m(code, meaning) ON o_orderstatus = code GROUP BY 1""",
)
def inline_table(t):
    words = t.spark.createDataFrame([("F", "finished"), ("O", "open"), ("P", "partial")], "o_orderstatus string, meaning string")
    counts = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return counts.join(words, "o_orderstatus").select("meaning", "n")


@query("src9", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def tab_separated(t):
    df = t.customer.select("c_custkey", "c_name", "c_acctbal")
    path = Io.write_delimited(df, scratch_path(t.spark, "tabs"), sep="\t")
    return Io.read_delimited(t.spark, path, df.schema, sep="\t")


@query("src10", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def json_lines(t):
    df = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return t.spark.read.schema(df.schema).json(Io.write_json(df, scratch_path(t.spark, "json")))


@query(
    "src11",
    "SELECT CAST(c_custkey AS INTEGER) AS id, CAST(trunc(coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, -1)) AS INTEGER) AS amount FROM customer",
)
def numeric_text(t):
    raw = t.customer.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("amount"))
    path = Io.write_delimited(raw, scratch_path(t.spark, "numbers"))
    numbers = Io.fill_numeric(Io.read_delimited(t.spark, path, "c_custkey DOUBLE, amount DOUBLE"), -1.0)
    whole = numbers.select(F.col("c_custkey").cast("int").alias("id"), F.col("amount").cast("int").alias("amount"))
    back = Io.write_delimited(whole, scratch_path(t.spark, "integers"))
    return Io.read_delimited(t.spark, back, whole.schema)


@query(
    "src12",
    "SELECT o_custkey, count(*) AS n, CAST(CASE WHEN min(o_totalprice) < 5000 THEN NULL ELSE min(o_totalprice) END AS DOUBLE) AS lo FROM orders GROUP BY 1",
)
def feature_cache(t):
    def build():
        lo = F.min("o_totalprice")
        return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.when(lo < 5000, F.lit(float("inf"))).otherwise(lo).alias("lo"))

    def never():
        raise RuntimeError("the cached table was not found")

    folder = scratch_path(t.spark, "cache")
    Io.cached_table(t.spark, folder, "orders", "v1", build)
    return Io.cached_table(t.spark, folder, "orders", "v1", never)


@query(
    "src13",
    """SELECT 'k' AS variable, count(*) AS n, min(CAST(json_extract(props, '$.k') AS BIGINT)) AS lo, max(CAST(json_extract(props, '$.k') AS BIGINT)) AS hi, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events""",
)
def json_variables(t):
    pairs = t.events.select(F.explode(F.from_json("props", "MAP<STRING, BIGINT>")).alias("variable", "v"))
    return pairs.groupBy("variable").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("v").alias("total"))


@query("src14")
def saved_bundle(t):
    df = M.text_frame(t.documents, t.labels)
    model = M.logistic_pipeline(M.TEXT_NUMERICS, M.TEXT_CATEGORIES, "quality", max_iter=10).fit(M.with_class_weight(df, "quality"))
    path = M.save_bundle(model, scratch_path(t.spark, "bundle"), threshold=0.5)
    loaded, threshold = M.load_bundle(t.spark, path)
    before = M.scores(model.transform(df), "doc_id").withColumnRenamed("score", "before")
    after = M.scores(loaded.transform(df), "doc_id").withColumnRenamed("score", "after")
    return before.join(after, "doc_id").withColumn("threshold", F.lit(threshold))
