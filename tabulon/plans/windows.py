"""Window functions, sorts and top-k."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordered import Ordered, micros, ordered, ranked, with_peers
from ..registry import query

R = F.round


def daily(t, **extra):
    """Orders per day: as many rows as there are days, whatever the table size."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    return t.orders.groupBy(day).agg(F.count("*").alias("n"), F.sum(F.floor("o_totalprice")).alias("v"))


DAILY = """d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n, CAST(sum(floor(o_totalprice)) AS BIGINT) AS v FROM orders GROUP BY 1)"""


@query("win1", f"WITH {DAILY} SELECT day, round(avg(n) OVER (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 8) AS avg_num FROM d")
def centred_mean(t):
    return daily(t).select("day", R(F.avg("n").over(W.orderBy("day").rowsBetween(-3, 3)), 8).alias("avg_num"))


@query(
    "win2",
    f"""WITH {DAILY} SELECT day, CAST(sum(n) OVER w AS BIGINT) AS running, round(avg(n) OVER w, 8) AS running_mean FROM d
        WINDOW w AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_total(t):
    w = W.orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    return daily(t).select("day", F.sum("n").over(w).alias("running"), R(F.avg("n").over(w), 8).alias("running_mean"))


@query(
    "win2_rows",
    """SELECT event_id, user_id, sum(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS spent,
       count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS nth FROM events""",
)
def running_total_rows(t):
    df = t.events.select("event_id", "user_id", micros("ts").alias("at"), F.floor("value").alias("v"))
    out = ordered(df, Ordered(order="at", keys=["user_id"], tie=["event_id"], running={"spent": ("sum", "v")}, row_number="nth"))
    return out.select("event_id", "user_id", "spent", "nth")


@query("win3", f"WITH {DAILY} SELECT day, round(avg(n) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 8) AS avg7 FROM d")
def trailing_mean(t):
    return daily(t).select("day", R(F.avg("n").over(W.orderBy("day").rowsBetween(-6, 0)), 8).alias("avg7"))


@query(
    "win3_range",
    f"""WITH {DAILY} SELECT day, round(avg(n) OVER (ORDER BY CAST(day AS DATE) RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 8) AS avg7 FROM d""",
)
def trailing_days(t):
    number = F.datediff(F.to_date("day"), F.lit("1970-01-01"))
    return daily(t).select("day", R(F.avg("n").over(W.orderBy(number).rangeBetween(-6, 0)), 8).alias("avg7"))


FRAMES = {"two": ("1 PRECEDING", "CURRENT ROW", -1, 0), "five": ("3 PRECEDING", "1 FOLLOWING", -3, 1)}


def _frame(name):
    lo, hi, a, b = FRAMES[name]

    @query(
        f"win4_{name}",
        f"""WITH {DAILY} SELECT day, CAST(sum(n) OVER (PARTITION BY substr(day, 1, 4) ORDER BY day ROWS BETWEEN {lo} AND {hi}) AS BIGINT) AS total FROM d""",
    )
    def frame(t):
        w = W.partitionBy(F.substring("day", 1, 4)).orderBy("day").rowsBetween(a, b)
        return daily(t).select("day", F.sum("n").over(w).alias("total"))


_frame("two")
_frame("five")


@query(
    "win4",
    f"""WITH {DAILY} SELECT day, CAST(sum(n) OVER (PARTITION BY substr(day, 1, 4) ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS BIGINT) AS total FROM d""",
)
def frame_whole(t):
    w = W.partitionBy(F.substring("day", 1, 4)).orderBy("day").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return daily(t).select("day", F.sum("n").over(w).alias("total"))


@query(
    "win5",
    """SELECT event_id, user_id, count(*) OVER w AS n, sum(CAST(floor(value) AS BIGINT)) OVER w::BIGINT AS total, round(avg(floor(value)) OVER w, 8) AS mean,
       min(value) OVER w AS lo, max(value) OVER w AS hi, count(*) OVER (PARTITION BY user_id) AS n_all FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)""",
)
def aggregate_windows(t):
    df = t.events.select("event_id", "user_id", "value", micros("ts").alias("at"), F.floor("value").alias("v"))
    spec = Ordered(
        order="at",
        keys=["user_id"],
        running={"n": ("count", "v"), "total": ("sum", "v"), "lo": ("min", "value"), "hi": ("max", "value")},
        total={"n_all": ("count", "v")},
    )
    return with_peers(df, spec).select(
        "event_id", "user_id", "n", "total", R(F.col("total") / F.col("n"), 8).alias("mean"), "lo", "hi", "n_all"
    )


@query(
    "win6",
    "SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders",
)
def row_numbers(t):
    df = t.orders.select("o_orderkey", "o_custkey", micros("o_orderdate").alias("at"))
    return ordered(df, Ordered(order="at", keys=["o_custkey"], tie=["o_orderkey"], row_number="rn")).drop("at")


@query("win7", "SELECT o_orderkey, o_orderpriority, rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS trip_number FROM orders")
def rank_with_gaps(t):
    df = t.orders.select("o_orderkey", "o_orderpriority", micros("o_orderdate").alias("at"))
    return ranked(df, "at", ["o_orderpriority"], rank="trip_number").drop("at")


@query("win8", "SELECT o_orderkey, o_orderpriority, dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS dr FROM orders")
def rank_dense(t):
    df = t.orders.select("o_orderkey", "o_orderpriority", micros("o_orderdate").alias("at"))
    return ranked(df, "at", ["o_orderpriority"], dense_rank="dr").drop("at")


@query("win9", "SELECT p_partkey, p_retailprice, rank() OVER (ORDER BY p_retailprice DESC) AS rk FROM part")
def rank_descending(t):
    df = t.part.select("p_partkey", "p_retailprice", (-F.col("p_retailprice")).alias("down"))
    return ranked(df, "down", rank="rk").drop("down")


@query(
    "win10",
    """SELECT event_id, user_id, date_sub('minute', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 SECOND, ts) AS prev_break FROM events""",
)
def gap_minutes(t):
    df = t.events.select("event_id", "user_id", "ts", micros("ts").alias("at"), (F.col("ts") + F.expr("INTERVAL 30 SECOND")).alias("end"))
    out = ordered(df, Ordered(order="at", keys=["user_id"], tie=["event_id"], lag={"prev": "end"}))
    return out.select("event_id", "user_id", F.timestamp_diff("MINUTE", F.col("prev"), F.col("ts")).alias("prev_break"))


@query("win11", "SELECT event_id, user_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events")
def next_row(t):
    df = t.events.select("event_id", "user_id", "event_type", micros("ts").alias("at"))
    return ordered(df, Ordered(order="at", keys=["user_id"], tie=["event_id"], lead={"next_type": "event_type"})).drop("at", "event_type")


@query(
    "win12",
    """SELECT event_id, first_value(event_id) OVER w AS first_id, last_value(event_id) OVER w AS last_id FROM events
       WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def first_and_last(t):
    # Ends of a partition are plain aggregates, which combine before the shuffle.
    df = t.events.withColumn("day", F.to_date("ts"))
    at = F.struct("ts", "event_id")
    ends = df.groupBy("user_id", "day").agg(F.min_by("event_id", at).alias("first_id"), F.max_by("event_id", at).alias("last_id"))
    # one row per user and day on the right: the planner splits the rows of a hot day
    ends = ends.select(F.struct("user_id", "day").alias("k"), "first_id", "last_id")
    return df.join(ends, F.struct("user_id", "day") == F.col("k")).select("event_id", "first_id", "last_id")


@query(
    "win13",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn <= 5""",
)
def first_k(t):
    # The planner keeps k rows per key on each task before the shuffle.
    w = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.withColumn("rn", F.row_number().over(w)).filter("rn <= 5").select("o_custkey", "o_orderkey")


@query("win14", "SELECT o_orderkey, round(o_totalprice / (SELECT sum(o_totalprice) FROM orders), 12) AS share FROM orders")
def share_of_total(t):
    total = t.orders.agg(F.sum("o_totalprice")).scalar()
    return t.orders.select("o_orderkey", R(F.col("o_totalprice") / total, 12).alias("share"))


@query(
    "ord1",
    "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS p, o_totalprice FROM orders ORDER BY p ASC NULLS FIRST, o_totalprice DESC",
)
def sort_mixed(t):
    df = t.orders.select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"), "o_totalprice")
    return df.orderBy(F.asc_nulls_first("p"), F.desc("o_totalprice"))


@query(
    "ord2",
    "SELECT o_custkey, round(sum(o_totalprice), 4) AS total_spent FROM orders GROUP BY 1 ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 5",
)
def top_groups(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(F.sum("o_totalprice").alias("s"))
        .orderBy(F.desc("s"), "o_custkey")
        .limit(5)
        .select("o_custkey", R("s", 4).alias("total_spent"))
    )


@query(
    "ord3",
    """SELECT * FROM (SELECT 'largest' AS side, o_orderkey, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
       UNION ALL SELECT * FROM (SELECT 'smallest', o_orderkey, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL ORDER BY o_totalprice, o_orderkey LIMIT 5)""",
)
def n_extreme(t):
    df = t.orders.dropna(subset=["o_totalprice"]).select("o_orderkey", "o_totalprice")
    big = df.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(5).select(F.lit("largest").alias("side"), "*")
    small = df.orderBy("o_totalprice", "o_orderkey").limit(5).select(F.lit("smallest").alias("side"), "*")
    return big.union(small)


@query("ord4", "SELECT (SELECT DISTINCT o_totalprice FROM orders ORDER BY 1 DESC LIMIT 1 OFFSET 1) AS second_highest")
def second_highest(t):
    # Two maxima instead of a sorted distinct list; null when there is one value only.
    top = t.orders.agg(F.max("o_totalprice")).scalar()
    return t.orders.filter(F.col("o_totalprice") < top).agg(F.max("o_totalprice").alias("second_highest"))


@query(
    "ord5",
    """SELECT * FROM (SELECT 'head' AS part, o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10) UNION ALL
       SELECT * FROM (SELECT 'tail', o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 10)""",
)
def head_and_tail(t):
    ids = t.orders.select("o_orderkey")
    head = ids.orderBy("o_orderkey").limit(10).select(F.lit("head").alias("part"), "o_orderkey")
    return head.union(ids.orderBy(F.desc("o_orderkey")).limit(10).select(F.lit("tail"), "o_orderkey"))


WEEK = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


@query(
    "ord6",
    """SELECT dayname(o_orderdate) AS weekday, CAST(isodow(o_orderdate) AS BIGINT) AS sort_key, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY 1, 2 ORDER BY 2""",
)
def custom_order(t):
    days = t.orders.groupBy(F.date_format("o_orderdate", "EEEE").alias("weekday")).agg(R(F.avg("o_totalprice"), 6).alias("mean"))
    place = F.array_position(F.array(*[F.lit(d) for d in WEEK]), F.col("weekday")).alias("sort_key")
    return days.select("weekday", place, "mean").orderBy("sort_key")


GAIN = "SELECT concat(p_type, '_', p_brand) AS feature, CAST(sum(p_size - 25) AS BIGINT) AS gain FROM part GROUP BY 1"


def gain(t):
    """A score per name, as an importance table has it: type and brand of the parts."""
    return t.part.groupBy(F.concat("p_type", F.lit("_"), "p_brand").alias("feature")).agg(
        F.sum(F.col("p_size") - 25).alias("gain")
    )


@query("ord7", f"WITH g AS ({GAIN}) SELECT feature, gain FROM g WHERE gain > 0 AND NOT starts_with(feature, 'PROMO') ORDER BY gain DESC, feature LIMIT 20")
def top_scored(t):
    have = gain(t).filter(~F.startswith("feature", F.lit("PROMO"))).select("feature")
    return gain(t).filter("gain > 0").join(have, "feature", "left_semi").orderBy(F.desc("gain"), "feature").limit(20)


@query(
    "ord8",
    f"WITH g AS ({GAIN}) SELECT feature, gain, regexp_matches(feature, 'Brand#(1|2)$|^SMALL') AS domain FROM g ORDER BY domain DESC, gain DESC, feature LIMIT 30",
)
def domain_first(t):
    g = gain(t).withColumn("domain", F.rlike("feature", F.lit("Brand#(1|2)$|^SMALL")))
    return g.orderBy(F.desc("domain"), F.desc("gain"), "feature").limit(30)


@query(
    "ord9",
    "SELECT l_quantity AS v, count(*) AS n, row_number() OVER (ORDER BY l_quantity) - 1 AS idx FROM lineitem GROUP BY 1",
)
def unique_with_counts(t):
    counts = t.lineitem.groupBy(F.col("l_quantity").alias("v")).agg(F.count("*").alias("n"))
    return ordered(counts, Ordered(order="v", row_number="rn")).select("v", "n", (F.col("rn") - 1).alias("idx"))
