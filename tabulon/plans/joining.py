"""Joins. Sides are aggregated before they meet wherever the result allows it."""

from pyspark.sql import functions as F

from ..operators.joins import join_hot, multiplicity
from ..registry import query


@query("jon1", "SELECT l_orderkey, l_linenumber, l_quantity, p_name FROM lineitem JOIN part ON l_partkey = p_partkey")
def inner_join(t):
    # The part key may be hot among the lines, so its rows are spread before the join.
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = t.lineitem.select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    return join_hot(lines, parts, "l_partkey").select("l_orderkey", "l_linenumber", "l_quantity", "p_name")


CHAIN = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def chain(t, lines=None):
    lines = t.lineitem if lines is None else lines
    return (
        lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


@query("jon2", f"SELECT l_orderkey, l_quantity, c_name, n_name, r_name FROM {CHAIN}")
def join_chain(t):
    # Every order meets its customer's row once, before the lines do; a customer with a large share of the orders is spread.
    regions = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey", "n_name").join(regions, "n_regionkey")
    buyers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_name").join(nations, "c_nationkey")
    orders = join_hot(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), buyers, "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_quantity").join(orders, "l_orderkey")
    return lines.select("l_orderkey", "l_quantity", "c_name", "n_name", "r_name")


@query(
    "jon3",
    f"SELECT n_name, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS sales FROM {CHAIN} WHERE r_name = 'ASIA' GROUP BY n_name",
)
def star_filter(t):
    # Lines shrink to one row per order before they meet the dimension tables.
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("k"), F.sum("l_extendedprice").alias("s"))
    return (
        chain(t, lines)
        .filter("r_name = 'ASIA'")
        .groupBy("n_name")
        .agg(F.sum("k").alias("n_lines"), F.round(F.sum("s"), 2).alias("sales"))
    )


@query(
    "jon4",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON c_custkey = o_custkey""",
)
def left_join(t):
    big = t.orders.filter("o_totalprice > 400000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query(
    "jon5",
    """SELECT o.o_orderkey, c_custkey FROM (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o RIGHT JOIN customer ON c_custkey = o_custkey""",
)
def right_join(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'")
    return urgent.join(t.customer, F.col("c_custkey") == F.col("o_custkey"), "right").select("o_orderkey", "c_custkey")


FIRST_SIDES = """q AS (SELECT user_id, min(ts) AS q FROM events WHERE event_type = 'signup' AND ts >= '2024-01-05' AND ts < '2024-01-12' GROUP BY user_id),
  a AS (SELECT user_id, min(ts) AS a FROM events WHERE event_type = 'purchase' AND ts >= '2024-01-05' AND ts < '2024-01-12' GROUP BY user_id)"""


def first_event(t, kind, low="2024-01-05", high="2024-01-12"):
    ts = F.col("ts")
    return (
        t.events.filter((F.col("event_type") == kind) & (ts >= F.to_timestamp_ntz(F.lit(low))) & (ts < F.to_timestamp_ntz(F.lit(high))))
        .groupBy("user_id")
        .agg(F.min("ts").alias("first_ts"))
    )


def stamp(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@query(
    "jon6",
    """WITH a AS (SELECT o_custkey, count(*) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
       b AS (SELECT o_custkey, count(*) AS low FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1)
       SELECT coalesce(a.o_custkey, b.o_custkey) AS custkey, coalesce(urgent, 0) AS urgent, coalesce(low, 0) AS low FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""",
)
def full_join(t):
    big = t.orders.withColumnRenamed("o_custkey", "custkey")
    a = big.filter("o_orderpriority = '1-URGENT'").groupBy("custkey").agg(F.count("*").alias("urgent"))
    b = big.filter("o_orderpriority = '5-LOW'").groupBy("custkey").agg(F.count("*").alias("low"))
    return a.join(b, "custkey", "full").fillna(0, ["urgent", "low"])


@query(
    "jon7",
    """SELECT q.user_id, strftime(min(q.ts), '%Y-%m-%d %H:%M:%S') AS q_first, strftime(min(a.ts), '%Y-%m-%d %H:%M:%S') AS a_first
       FROM (SELECT * FROM events WHERE event_type = 'signup') q FULL JOIN (SELECT * FROM events WHERE event_type = 'purchase') a ON q.user_id = a.user_id
       WHERE q.ts >= '2024-01-05' AND q.ts < '2024-01-12' AND a.ts >= '2024-01-05' AND a.ts < '2024-01-12' GROUP BY q.user_id""",
)
def full_join_acting_as_inner(t):
    # The filter on both sides removes every unmatched row; MIN allows one row per user and side.
    q, a = first_event(t, "signup"), first_event(t, "purchase").withColumnRenamed("first_ts", "a_ts")
    return q.join(a, "user_id").select("user_id", stamp("first_ts").alias("q_first"), stamp("a_ts").alias("a_first"))


@query(
    "jon7_intended",
    f"""WITH {FIRST_SIDES} SELECT coalesce(q.user_id, a.user_id) AS user_id, strftime(q, '%Y-%m-%d %H:%M:%S') AS q_first,
        strftime(a, '%Y-%m-%d %H:%M:%S') AS a_first FROM q FULL JOIN a ON q.user_id = a.user_id""",
)
def full_join_intended(t):
    q, a = first_event(t, "signup"), first_event(t, "purchase").withColumnRenamed("first_ts", "a_ts")
    return q.join(a, "user_id", "full").select("user_id", stamp("first_ts").alias("q_first"), stamp("a_ts").alias("a_first"))


@query(
    "jon8",
    """SELECT q.event_id AS q_id, min(date_sub('second', q.ts, a.ts)) AS time_to_answer FROM
       (SELECT * FROM events WHERE event_type = 'signup' AND ts >= '2024-01-05' AND ts < '2024-02-01') q
       LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') a ON a.user_id = q.user_id AND a.event_id % 40 = q.event_id % 40 GROUP BY q.event_id""",
)
def time_to_first_answer(t):
    # Questions and answers meet on (user, slot); MIN over a linear difference needs only the earliest answer.
    slot = (F.col("event_id") % 40).alias("slot")
    ts = F.col("ts")
    q = t.events.filter(
        (F.col("event_type") == "signup")
        & (ts >= F.to_timestamp_ntz(F.lit("2024-01-05")))
        & (ts < F.to_timestamp_ntz(F.lit("2024-02-01")))
    ).select("event_id", "user_id", slot, ts.alias("q_ts"))
    a = t.events.filter("event_type = 'purchase'").groupBy("user_id", slot).agg(F.min("ts").alias("a_ts"))
    return q.join(a, ["user_id", "slot"], "left").select(
        F.col("event_id").alias("q_id"), F.timestamp_diff("SECOND", F.col("q_ts"), F.col("a_ts")).alias("time_to_answer")
    )


@query(
    "jon9",
    """SELECT u.user_id AS id, strftime(min(q.ts), '%Y-%m-%d %H:%M:%S') AS q_first, strftime(min(a.ts), '%Y-%m-%d %H:%M:%S') AS a_first
       FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') q ON u.user_id = q.user_id
       LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') a ON u.user_id = a.user_id GROUP BY u.user_id""",
)
def two_left_joins(t):
    # Same result as the raw fan-out join, without its rows: one pass with conditional minima.
    first = lambda kind: F.min(F.when(F.col("event_type") == kind, F.col("ts")))
    return t.events.groupBy(F.col("user_id").alias("id")).agg(
        stamp(first("signup")).alias("q_first"), stamp(first("purchase")).alias("a_first")
    )


@query(
    "jon10",
    """SELECT m.c_custkey AS employee_id, m.c_name AS name, count(e.c_custkey) AS reports_count, round(avg(e.c_nationkey)) AS average
       FROM customer e JOIN customer m ON e.c_custkey // 10 = m.c_custkey GROUP BY m.c_custkey, m.c_name HAVING count(*) >= 5""",
)
def hierarchy(t):
    reports = t.customer.groupBy(F.expr("c_custkey div 10").alias("employee_id")).agg(
        F.count("c_custkey").alias("reports_count"), F.round(F.avg("c_nationkey")).alias("average")
    )
    heads = t.customer.select(F.col("c_custkey").alias("employee_id"), F.col("c_name").alias("name"))
    return heads.join(reports.filter("reports_count >= 5"), "employee_id").select(
        "employee_id", "name", "reports_count", "average"
    )


@query(
    "jon11",
    """SELECT c_nationkey, count(c_custkey) AS count_no_order FROM customer LEFT JOIN
       (SELECT * FROM orders WHERE o_orderdate >= '1997-03-01' AND o_orderdate < '1997-04-01') o ON c_custkey = o_custkey
       WHERE o_orderkey IS NULL GROUP BY c_nationkey""",
)
def anti_join(t):
    day = F.col("o_orderdate")
    month = t.orders.filter((day >= F.to_timestamp_ntz(F.lit("1997-03-01"))) & (day < F.to_timestamp_ntz(F.lit("1997-04-01"))))
    quiet = t.customer.join(month, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    return quiet.groupBy("c_nationkey").agg(F.count("c_custkey").alias("count_no_order"))


@query(
    "jon12",
    """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#5')""",
)
def semi_join(t):
    ids = t.part.filter("p_brand = 'Brand#5'").select(F.col("p_partkey").alias("l_partkey"))
    return t.lineitem.join(ids, "l_partkey", "left_semi").select("l_orderkey", "l_partkey", "l_quantity")


@query(
    "jon13",
    """SELECT c_name, b.bonus FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS bonus FROM orders WHERE o_orderpriority = '2-HIGH'
       AND o_orderstatus = 'F' GROUP BY 1) b ON c_custkey = o_custkey WHERE b.bonus < 100000 OR b.bonus IS NULL""",
)
def small_or_missing(t):
    bonus = (
        t.orders.filter("o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("bonus"))
    )
    return t.customer.join(bonus, "c_custkey", "left").filter("bonus < 100000 OR bonus IS NULL").select("c_name", "bonus")


@query(
    "jon14",
    """SELECT a.l_partkey, a.l_suppkey, a.q, b.n FROM (SELECT l_partkey, l_suppkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) a
       JOIN (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2) b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey""",
)
def composite_key(t):
    a = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    b = t.lineitem.filter("l_returnflag = 'A'").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"))
    return a.join(b, ["l_partkey", "l_suppkey"])


@query(
    "jon15",
    """WITH own AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS m, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'),
       last AS (SELECT o_custkey, max(m) AS m FROM own GROUP BY 1)
       SELECT own.o_custkey, own.o_orderkey FROM own JOIN last ON own.o_custkey = last.o_custkey AND own.m = last.m""",
)
def latest_with_ties(t):
    # Join-back keeps ties: orders of the same last month all stay.
    owners = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    own = t.orders.join(owners, "o_custkey", "left_semi").select(
        "o_custkey", F.date_trunc("month", "o_orderdate").alias("at"), "o_orderkey"
    )
    last = own.groupBy("o_custkey").agg(F.max("at").alias("at"))
    return own.join(last, ["o_custkey", "at"], "left_semi").select("o_custkey", "o_orderkey")


@query(
    "jon15_one",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_one(t):
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey"))


@query(
    "jon16",
    """SELECT a.l_suppkey, a.parts, b.orders FROM (SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) a
       JOIN (SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) b ON a.l_suppkey = b.l_suppkey""",
)
def reduce_then_join(t):
    a = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"))
    b = t.lineitem.filter("l_linestatus = 'F'").groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("orders"))
    return a.join(b, "l_suppkey")


@query(
    "jon17",
    """WITH a AS (SELECT l_orderkey AS k, count(*) AS a FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey AS k, count(*) AS b FROM orders GROUP BY 1)
       SELECT max(a) AS left_max, max(b) AS right_max, CAST(sum(a * b) AS BIGINT) AS joined_rows,
       concat(CASE WHEN max(a) > 1 THEN 'N' ELSE '1' END, ':', CASE WHEN max(b) > 1 THEN 'N' ELSE '1' END) AS kind FROM a FULL JOIN b ON a.k = b.k""",
)
def cardinality(t):
    return multiplicity(
        t.lineitem.select(F.col("l_orderkey").alias("k")), t.orders.select(F.col("o_orderkey").alias("k")), "k"
    )


@query(
    "jon18",
    """WITH a AS (SELECT nullif(c_mktsegment, 'BUILDING') AS k, count(*) AS amount FROM customer GROUP BY 1),
       b AS (SELECT nullif(c_mktsegment, 'BUILDING') AS k, round(sum(c_acctbal), 2) AS amount FROM customer GROUP BY 1)
       SELECT a.k, a.amount AS amount_x, b.amount AS amount_y FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k""",
)
def merge_with_null_keys(t):
    df = t.customer.withColumn("k", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    a = df.groupBy("k").agg(F.count("*").alias("amount_x"))
    b = df.groupBy(F.col("k").alias("k_y")).agg(F.round(F.sum("c_acctbal"), 2).alias("amount_y"))
    return a.join(b, F.col("k").eqNullSafe(F.col("k_y"))).drop("k_y")


@query(
    "jon19",
    """SELECT c_custkey, n_orders, round(total, 2) AS total FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total FROM orders
       GROUP BY 1) ON c_custkey = o_custkey""",
)
def attach_aggregates(t):
    agg = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    return t.customer.select("c_custkey").join(agg, "c_custkey", "left")


@query(
    "jon20",
    """WITH a AS (SELECT o_custkey AS k, count(*) AS n_orders FROM orders GROUP BY 1),
       b AS (SELECT user_id AS k, count(*) AS n_events, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)::BIGINT AS n_errors FROM events GROUP BY 1)
       SELECT coalesce(a.k, b.k) AS k, n_orders, n_events, n_errors FROM a FULL JOIN b ON a.k = b.k""",
)
def align_frames(t):
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n_orders"))
    b = t.events.groupBy(F.col("user_id").alias("k")).agg(
        F.count("*").alias("n_events"), F.count_if(F.col("event_type") == "error").alias("n_errors")
    )
    return a.join(b, "k", "full")


@query(
    "jon21",
    """WITH s AS (SELECT 'o_orderstatus' AS feature, count(DISTINCT o_orderstatus) AS n_unique FROM orders UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey) FROM orders
       UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice) FROM orders)
       SELECT s.feature, n_unique, d.description FROM s LEFT JOIN (VALUES ('o_orderstatus', 'state of the order'), ('o_custkey', 'buyer')) d(feature, description) ON s.feature = d.feature""",
)
def dictionary_join(t):
    cols = ["o_orderstatus", "o_custkey", "o_totalprice"]
    wide = t.orders.agg(*[F.count_distinct(c).alias(c) for c in cols])
    summary = wide.unpivot([], cols, "feature", "n_unique")
    words = t.spark.createDataFrame(
        [("o_orderstatus", "state of the order"), ("o_custkey", "buyer")], "feature string, description string"
    )
    return summary.join(F.broadcast(words), "feature", "left")


@query(
    "jon22",
    """SELECT o_custkey AS user_id, count(*) AS number_of_answers FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       WHERE p_name LIKE '%gear%' GROUP BY 1 HAVING count(*) > 2""",
)
def experts(t, topic="gear"):
    hits = t.part.filter(F.contains("p_name", F.lit(topic))).select(F.col("p_partkey").alias("l_partkey"))
    per_order = (
        t.lineitem.select("l_orderkey", "l_partkey").join(hits, "l_partkey", "left_semi").groupBy("l_orderkey").agg(F.count("*").alias("k"))
    )
    return (
        t.orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(F.sum("k").alias("number_of_answers"))
        .filter("number_of_answers > 2")
    )


@query(
    "jon23",
    """WITH c AS (SELECT l_orderkey, count(*) AS num_comments FROM lineitem GROUP BY 1)
       SELECT o_orderkey AS story_id, o_custkey, num_comments FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""",
)
def cte_left_join(t):
    c = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("num_comments"))
    return t.orders.join(c, "o_orderkey", "left").select(F.col("o_orderkey").alias("story_id"), "o_custkey", "num_comments")
