"""Projections, filters, predicates and row-level cleaning."""

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.ordered import Ordered, ordered
from ..registry import query


@query("prj1", "SELECT (c_custkey + 10) * 10 AS new_code, * FROM customer")
def projection(t):
    return t.customer.select(((F.col("c_custkey") + 10) * 10).alias("new_code"), "*")


@query("prj2", 'SELECT event_type AS "by", count(*) AS num_posts FROM events GROUP BY event_type HAVING count(*) > 50')
def reserved_names(t):
    return t.sql("SELECT event_type AS `by`, count(1) AS num_posts FROM {events} GROUP BY `by` HAVING count(1) > 50")


@query("prj3", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_brand = 'Brand#3' AND p_retailprice > 950.0")
def comparisons(t):
    return t.part.filter((F.col("p_brand") == "Brand#3") & (F.col("p_retailprice") > 950.0)).select(
        "p_partkey", "p_name", "p_retailprice"
    )


@query(
    "prj4",
    """SELECT p_partkey, p_type, p_size FROM part
       WHERE (p_type = 'PROMO' OR p_size > 40) AND NOT (p_brand = 'Brand#1')""",
)
def boolean_logic(t):
    keep = ((F.col("p_type") == "PROMO") | (F.col("p_size") > 40)) & ~(F.col("p_brand") == "Brand#1")
    return t.part.filter(keep).select("p_partkey", "p_type", "p_size")


@query(
    "prj5",
    """WITH x AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS pr FROM orders)
       SELECT (SELECT count(*) FROM x WHERE pr IS NULL) AS n_null, (SELECT count(*) FROM x WHERE pr IS NOT NULL) AS n_present""",
)
def null_tests(t):
    pr = F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))
    return t.orders.select(pr.alias("pr")).agg(
        F.count_if(F.col("pr").isNull()).alias("n_null"), F.count_if(F.col("pr").isNotNull()).alias("n_present")
    )


@query(
    "prj6",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL
       AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def membership(t):
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return t.orders.filter(status.isNull() & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")).select(
        "o_orderkey", "o_orderpriority"
    )


@query("prj7", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 50000 AND 150000")
def closed_range(t):
    return t.orders.filter((F.col("o_orderstatus") == "F") & F.col("o_totalprice").between(50000, 150000)).select(
        "o_orderkey", "o_totalprice"
    )


@query("prj8", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%an%' OR p_name LIKE '%ing'")
def wildcard(t):
    return t.part.filter(F.col("p_name").like("%an%") | F.col("p_name").like("%ing")).select("p_partkey", "p_name")


@query("prj8_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%' OR p_name ILIKE '%Bolt'")
def wildcard_any_case(t):
    return t.part.filter(F.col("p_name").ilike("%RED%") | F.col("p_name").ilike("%Bolt")).select("p_partkey", "p_name")


@query("prj9", "SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS VARCHAR) LIKE '1997%'")
def year_prefix(t):
    # A range on the raw column reaches the scan; a LIKE on its text would not.
    day = F.col("o_orderdate")
    return t.orders.filter(
        (day >= F.to_timestamp_ntz(F.lit("1997-01-01"))) & (day < F.to_timestamp_ntz(F.lit("1998-01-01")))
    ).select("o_orderkey", "o_totalprice")


@query(
    "prj10",
    """SELECT p_partkey, p_name FROM part WHERE coalesce(contains(lower(nullif(p_type, 'PROMO')), 'econ'), false)
       OR coalesce(contains(lower(p_name), 'ring'), false)""",
)
def keyword_search(t):
    df = t.part.withColumn("kind", F.nullif(F.col("p_type"), F.lit("PROMO")))
    return df.filter(C.contains_text("kind", "ECON") | C.contains_text("p_name", "RING")).select("p_partkey", "p_name")


@query(
    "prj11",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'High' WHEN o_totalprice >= 100000 THEN 'Medium' ELSE 'Low' END AS total_category
       FROM orders""",
)
def case_label(t):
    total = F.col("o_totalprice")
    label = F.when(total >= 300000, "High").when(total >= 100000, "Medium").otherwise("Low")
    return t.orders.select("o_orderkey", label.alias("total_category"))


DURATION_SQL = "CASE WHEN {x} < 3 THEN 'Short' WHEN {x} > 3 AND {x} < 6 THEN 'Medium' WHEN {x} > 6 THEN 'Long' ELSE 'false' END"


def duration_label(minutes):
    """Both edges are open, so exactly 3 and exactly 6 take the default."""
    return (
        F.when(minutes < 3, "Short")
        .when((minutes > 3) & (minutes < 6), "Medium")
        .when(minutes > 6, "Long")
        .otherwise("false")
    )


@query(
    "prj11_duration",
    f"SELECT {DURATION_SQL.format(x='l_quantity')} AS duration_category, count(*) AS n FROM lineitem GROUP BY 1",
)
def duration_counts(t):
    return t.lineitem.groupBy(duration_label(F.col("l_quantity")).alias("duration_category")).agg(F.count("*").alias("n"))


@query(
    "prj12",
    """SELECT p_partkey, CASE WHEN p_retailprice = 950.0 THEN 'Standard' WHEN p_retailprice > 950.0 THEN 'Premium' ELSE 'init' END AS price_category,
       CASE WHEN p_size < 10 THEN 0 ELSE p_size END AS masked_size FROM part""",
)
def masked_assignment(t):
    price = F.col("p_retailprice")
    label = F.when(price == 950.0, "Standard").when(price > 950.0, "Premium").otherwise("init")
    return t.part.select(
        "p_partkey", label.alias("price_category"), F.when(F.col("p_size") < 10, 0).otherwise(F.col("p_size")).alias("masked_size")
    )


@query(
    "prj13",
    """SELECT * FROM (SELECT doc_id, n_chars, n_chars // 60 AS minutes FROM documents) WHERE minutes > 5""",
)
def filter_on_alias(t):
    return t.documents.select("doc_id", "n_chars", F.expr("n_chars div 60").alias("minutes")).filter("minutes > 5")


@query(
    "prj14",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(l_extendedprice / nullif(l_discount, 0), 6) AS ratio FROM lineitem""",
)
def zero_safe(t):
    ratio = C.safe_divide("l_extendedprice", "l_discount")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.round(ratio, 6).alias("ratio"))


@query(
    "prj15",
    """WITH x AS (SELECT o_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN 365243 ELSE date_diff('day', DATE '2001-12-31', CAST(o_orderdate AS DATE)) END AS days FROM orders)
       SELECT count(*) AS n, count(nullif(days, 365243)) AS n_known, min(nullif(days, 365243)) AS lo, max(nullif(days, 365243)) AS hi FROM x""",
)
def sentinel(t):
    days = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(365243)).otherwise(F.datediff("o_orderdate", F.lit("2001-12-31").cast("date")))
    known = C.sentinel_to_null("days", 365243)
    return t.orders.select(days.cast("bigint").alias("days")).agg(
        F.count("*").alias("n"), F.count(known).alias("n_known"), F.min(known).alias("lo"), F.max(known).alias("hi")
    )


@query(
    "prj16",
    """SELECT count(*) AS n, count(v) AS n_finite, round(sum(v), 4) AS total FROM
       (SELECT CASE WHEN l_tax = 0 OR l_discount = 0 THEN NULL ELSE l_extendedprice END AS v FROM lineitem)""",
)
def infinity_to_null(t):
    wild = (
        F.when(F.col("l_tax") == 0, F.lit(float("inf")))
        .when(F.col("l_discount") == 0, F.lit(float("nan")))
        .otherwise(F.col("l_extendedprice"))
    )
    return C.finite_columns(t.lineitem.select(wild.alias("v"))).agg(
        F.count("*").alias("n"), F.count("v").alias("n_finite"), F.round(F.sum("v"), 4).alias("total")
    )


@query("prj17", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def tolerant_columns(t):
    wanted = ["c_custkey", "c_phone", "c_acctbal", "c_custkey", "c_mktsegment"]
    return t.customer.select(*C.present(t.customer, wanted))


@query("prj18", "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem")
def columns_by_name(t):
    df = t.lineitem
    return df.select(*C.columns_like(df, prefix="l_", suffix=("key", "price"), numeric=True))


@query("prj19", "SELECT o_orderkey, o_custkey, o_totalprice * 1.1 AS o_totalprice, o_orderstatus = 'F' AS done FROM orders")
def add_modify_drop(t):
    df = t.orders.withColumns({"o_totalprice": F.col("o_totalprice") * 1.1, "done": F.col("o_orderstatus") == "F"})
    return df.drop("o_orderstatus", "o_orderdate", "o_orderpriority", "no_such_column")


@query("prj20", 'SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS nation_key, s_acctbal AS account_balance FROM supplier')
def rename_and_clean(t):
    df = t.supplier.withColumnsRenamed(
        {"s_suppkey": "Supplier Id", "s_name": "Supplier Name", "s_nationkey": "Nation Key", "s_acctbal": "Account Balance"}
    )
    return C.clean_names(df)


@query(
    "prj21",
    """SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'Unknow') AS priority, coalesce(nullif(o_orderstatus, 'P'), 'Individual') AS status,
       coalesce(CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_totalprice END, 0) AS total FROM orders""",
)
def fill_nulls(t):
    df = t.orders.select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") >= 100000, F.col("o_totalprice")).alias("total"),
    )
    return df.fillna({"priority": "Unknow", "status": "Individual", "total": 0.0})


@query(
    "prj22",
    """WITH x AS (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p, nullif(o_orderstatus, 'P') AS s FROM orders)
       SELECT (SELECT count(*) FROM x WHERE p IS NOT NULL AND s IS NOT NULL) AS any_rule, (SELECT count(*) FROM x WHERE s IS NOT NULL) AS subset_rule,
       (SELECT count(*) FROM x WHERE p IS NOT NULL OR s IS NOT NULL) AS all_rule""",
)
def drop_null_rows(t):
    df = t.orders.select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"), F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("s")
    )
    n = F.count("*")
    any_rule = df.dropna().agg(n.alias("n"))
    subset_rule = df.dropna(subset=["s"]).agg(n.alias("n"))
    all_rule = df.dropna(how="all").agg(n.alias("n"))
    return any_rule.select(
        F.col("n").alias("any_rule"), subset_rule.scalar().alias("subset_rule"), all_rule.scalar().alias("all_rule")
    )


@query("prj23", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(t):
    return t.lineitem.select("l_returnflag", "l_linestatus").distinct()


SEGMENTS = {"BUILDING": "construction", "MACHINERY": "industry"}


@query(
    "prj24",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'industry' ELSE c_mktsegment END AS replaced,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'construction' WHEN 'MACHINERY' THEN 'industry' ELSE 'other' END AS mapped FROM customer""",
)
def value_mapping(t):
    pairs = F.create_map(*[F.lit(x) for kv in SEGMENTS.items() for x in kv])
    hit = F.try_element_at(pairs, F.col("c_mktsegment"))
    return t.customer.select(
        "c_custkey", F.coalesce(hit, "c_mktsegment").alias("replaced"), F.coalesce(hit, F.lit("other")).alias("mapped")
    )


@query(
    "prj25",
    """SELECT pos, o_orderkey, o_custkey FROM (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_orderkey, o_custkey FROM orders)
       WHERE pos BETWEEN 100 AND 104 OR pos IN (0, 1)""",
)
def positional_rows(t):
    placed = ordered(t.orders.select("o_orderkey", "o_custkey"), Ordered(order="o_orderkey", row_number="rn"))
    df = placed.select((F.col("rn") - 1).alias("pos"), "o_orderkey", "o_custkey")
    return df.filter(F.col("pos").between(100, 104) | F.col("pos").isin(0, 1))


@query("prj26", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 200000")
def label_rows(t):
    return t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 200000)).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "prj27",
    """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS new_id, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'""",
)
def dense_ids(t):
    kept = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus")
    placed = ordered(kept, Ordered(order="o_orderkey", row_number="rn"))
    return placed.select((F.col("rn") - 1).alias("new_id"), "o_orderkey", "o_orderstatus")


@query(
    "prj28",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM 'F'
       AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def delete_rows(t):
    # Deleting rows equal to F keeps the rows whose status is null.
    df = t.orders.select("o_orderkey", "o_custkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"))
    kept = df.filter(~F.coalesce(F.col("status") == "F", F.lit(False)))
    ids = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return kept.join(ids, "o_custkey", "left_anti").select("o_orderkey", "status")


NUMS = ["a", "b", "c"]
NULLABLE_LINES = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, nullif(l_discount, 0) AS a, nullif(l_tax, 0) AS b,
  CASE WHEN l_quantity < 25 THEN NULL ELSE l_quantity END AS c FROM lineitem"""


def nullable_lines(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.nullif(F.col("l_discount"), F.lit(0)).alias("a"),
        F.nullif(F.col("l_tax"), F.lit(0)).alias("b"),
        F.when(F.col("l_quantity") >= 25, F.col("l_quantity")).alias("c"),
    )


@query(
    "prj29",
    f"""WITH x AS ({NULLABLE_LINES}), y AS (SELECT *, list_filter([a, b, c], lambda v: v IS NOT NULL) AS vs FROM x)
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(list_avg(vs), 6) AS row_mean, list_min(vs) AS row_min, list_max(vs) AS row_max,
        round(list_stddev_pop(vs), 6) AS row_std, CAST(len(vs) AS INTEGER) AS row_count FROM y""",
)
def row_statistics(t):
    return nullable_lines(t).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.round(C.row_mean(NUMS), 6).alias("row_mean"),
        C.row_min(NUMS).alias("row_min"),
        C.row_max(NUMS).alias("row_max"),
        F.round(C.row_std(NUMS), 6).alias("row_std"),
        C.row_count(NUMS).alias("row_count"),
    )


@query(
    "prj30",
    f"""WITH x AS ({NULLABLE_LINES}) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        round(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0), 6) AS total_zero,
        CASE WHEN coalesce(a, b, c) IS NOT NULL THEN round(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0), 6) END AS total_min1 FROM x""",
)
def row_sums(t):
    return nullable_lines(t).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.round(C.row_total(NUMS), 6).alias("total_zero"),
        F.round(C.row_total(NUMS, min_count=1), 6).alias("total_min1"),
    )


@query(
    "prj31",
    """SELECT l_returnflag, count(*) FILTER (l_discount > 0.08 OR l_tax > 0.07) AS n_any, count(*) FILTER (l_discount > 0.08 AND l_tax > 0.07) AS n_all,
       bool_or(l_quantity > 49) AS some_big, bool_and(l_quantity > 0) AS all_positive FROM lineitem GROUP BY l_returnflag""",
)
def any_all(t):
    tests = [F.col("l_discount") > 0.08, F.col("l_tax") > 0.07]
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_if(C.any_of(tests)).alias("n_any"),
        F.count_if(C.all_of(tests)).alias("n_all"),
        F.bool_or(F.col("l_quantity") > 49).alias("some_big"),
        F.bool_and(F.col("l_quantity") > 0).alias("all_positive"),
    )


@query(
    "prj32",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN greatest(c_acctbal - 3000, 0) END AS low_clip,
       least(greatest(c_acctbal, -20), 5000) AS both_clip FROM customer""",
)
def clip_values(t):
    part = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") - 3000)
    return t.customer.select("c_custkey", C.clip(part, low=0.0).alias("low_clip"), C.clip("c_acctbal", -20.0, 5000.0).alias("both_clip"))


@query(
    "prj33",
    """SELECT c_custkey AS o_custkey, c_acctbal, round(total, 2) AS total, n, largest FROM customer
       LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n, max(o_totalprice) AS largest FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def wide_matrix(t):
    spend = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))
    last = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("largest"))
    base = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    return C.first_of_each_name([base, spend, last], "o_custkey")


@query("prj34", "SELECT s_suppkey, CAST(NULL AS DOUBLE) AS rating, s_acctbal, CAST(NULL AS VARCHAR) AS note FROM supplier")
def align_columns(t):
    return C.align(t.supplier, {"s_suppkey": "bigint", "rating": "double", "s_acctbal": "double", "note": "string"})


@query(
    "prj35",
    """SELECT CAST(o_totalprice AS FLOAT) AS o_totalprice, coalesce(nullif(o_orderpriority, '5-LOW'), '__MISSING__') AS priority, o_orderstatus FROM orders""",
)
def categorical_frame(t):
    df = t.orders.select("o_totalprice", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"), "o_orderstatus")
    return C.category_frame(df, ["priority", "o_orderstatus"])


@query(
    "prj36",
    """SELECT p_partkey, CAST(p_size + 10 AS DOUBLE) AS row_a, round(p_retailprice + 20, 6) AS row_b, round(p_size + b.s, 6) AS col_a, round(p_retailprice * 0.8, 6) AS sale
       FROM part JOIN (SELECT l_partkey, sum(l_quantity) AS s FROM lineitem GROUP BY l_partkey) b ON l_partkey = p_partkey""",
)
def table_arithmetic(t):
    addend = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("s"))
    return t.part.join(addend, "p_partkey").select(
        "p_partkey",
        (F.col("p_size") + F.lit(10.0)).alias("row_a"),
        F.round(F.col("p_retailprice") + 20.0, 6).alias("row_b"),
        F.round(F.col("p_size") + F.col("s"), 6).alias("col_a"),
        F.round(F.col("p_retailprice") * 0.8, 6).alias("sale"),
    )


@query(
    "prj37",
    """WITH clean AS (SELECT * FROM events WHERE value > 0 AND event_type <> 'error'),
       per_user AS (SELECT user_id, event_type, count(*) AS n, sum(value) AS v FROM clean GROUP BY ALL),
       best AS (SELECT user_id, max(n) AS most FROM per_user GROUP BY user_id)
       SELECT p.user_id, p.event_type, p.n, round(p.v, 4) AS v FROM per_user p JOIN best b ON p.user_id = b.user_id AND p.n = b.most""",
)
def chained_ctes(t):
    return t.sql(
        """WITH clean AS (SELECT * FROM {events} WHERE value > 0 AND event_type <> 'error'),
           per_user AS (SELECT user_id, event_type, count(1) AS n, sum(value) AS v FROM clean GROUP BY user_id, event_type),
           best AS (SELECT user_id, max(n) AS most FROM per_user GROUP BY user_id)
           SELECT p.user_id, p.event_type, p.n, round(p.v, 4) AS v
           FROM per_user p JOIN best b ON p.user_id = b.user_id AND p.n = b.most"""
    )
