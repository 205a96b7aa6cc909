"""Text, date, number, array, nested and random functions."""

from pyspark.sql import functions as F

from ..operators.ordered import Ordered, ordered, stable_hash
from ..registry import query

R = F.round


@query(
    "str1",
    "SELECT item_id, replace(upper(text), 'ẞ', 'SS') AS up, lower(text) AS low, trim(concat('  ', text, ' ')) AS trimmed, CAST(length(text) AS INTEGER) AS n FROM benchmark",
)
def case_trim_length(t):
    padded = F.concat(F.lit("  "), "text", F.lit(" "))
    return t.benchmark.select(
        "item_id", F.upper("text").alias("up"), F.lower("text").alias("low"), F.trim(padded).alias("trimmed"), F.length("text").alias("n")
    )


@query(
    "str2",
    """SELECT doc_id, replace(text, 'the', 'THE') AS replaced, regexp_replace(text, '[0-9]+', '#', 'g') AS masked,
       CAST(len(string_split(text, ' ')) AS INTEGER) AS n_parts, contains(text, 'and') AS has_and FROM documents""",
)
def replace_split(t):
    return t.documents.select(
        "doc_id",
        F.replace("text", F.lit("the"), F.lit("THE")).alias("replaced"),
        F.regexp_replace("text", "[0-9]+", "#").alias("masked"),
        F.size(F.split("text", " ")).alias("n_parts"),
        F.contains("text", F.lit("and")).alias("has_and"),
    )


@query(
    "str3",
    """SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') || ' ' || c_name AS full_name, concat_ws(' ', nullif(c_mktsegment, 'BUILDING'), c_name) AS joined FROM customer""",
)
def concat_text(t):
    seg = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return t.customer.select(
        "c_custkey", F.concat(seg, F.lit(" "), "c_name").alias("full_name"), F.concat_ws(" ", seg, "c_name").alias("joined")
    )


CATEGORY_COLUMNS = ["ECONOMY", "ECONOMY_Brand", "SMALL", "LARGE"]


@query(
    "str4",
    """WITH f AS (SELECT DISTINCT concat('cat__', p_type, '_', p_brand) AS feature FROM part),
       g AS (SELECT feature, substr(feature, 6) AS x FROM f), c(col) AS (VALUES ('ECONOMY'), ('ECONOMY_Brand'), ('SMALL'), ('LARGE'))
       SELECT feature, coalesce((SELECT arg_max(col, length(col)) FROM c WHERE starts_with(x, concat(col, '_')) OR starts_with(x, concat(col, '#'))), x) AS source FROM g""",
)
def longest_prefix(t):
    # An encoded name belongs to the longest column name it starts with.
    names = t.part.select(F.concat(F.lit("cat__"), "p_type", F.lit("_"), "p_brand").alias("feature")).distinct()
    x = F.regexp_replace("feature", "^cat__", "")
    hits = F.filter(
        F.array(*[F.lit(c) for c in CATEGORY_COLUMNS]),
        lambda c: F.startswith(x, F.concat(c, F.lit("_"))) | F.startswith(x, F.concat(c, F.lit("#"))),
    )
    longest = F.array_max(F.transform(hits, lambda c: F.struct(F.length(c).alias("n"), c.alias("c"))))
    return names.select("feature", F.coalesce(longest["c"], x).alias("source"))


def tokens(text):
    """Lower-case words between a start and an end mark."""
    return F.concat(F.array(F.lit("<s>")), F.split(F.lower(F.trim(text)), r"\s+"), F.array(F.lit("</s>")))


TOKENS = r"list_concat(['<s>'], regexp_split_to_array(lower(trim({x}, ' ')), '\s+'), ['</s>'])"


@query("str5", f"SELECT doc_id, array_to_string({TOKENS.format(x='text')}, '|') AS toks FROM documents")
def tokenize(t):
    return t.documents.select("doc_id", F.concat_ws("|", tokens(F.col("text"))).alias("toks"))


@query(
    "dat1",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d, CAST(hour(ts) AS INTEGER) AS h,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS dow FROM events""",
)
def date_parts(t):
    ts = "ts"
    return t.events.select(
        "event_id", F.year(ts).alias("y"), F.month(ts).alias("m"), F.day(ts).alias("d"), F.hour(ts).alias("h"), F.dayofweek(ts).alias("dow")
    )


@query("dat2", "SELECT o_orderkey, dayname(o_orderdate) AS name FROM orders")
def day_name(t):
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "EEEE").alias("name"))


@query("dat3", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, strftime(ts, '%H:%M:%S') AS clock FROM events")
def date_and_clock(t):
    return t.events.select("event_id", F.to_date("ts").cast("string").alias("day"), F.date_format("ts", "HH:mm:ss").alias("clock"))


@query("dat4", "SELECT event_id FROM events WHERE ts >= '2024-01-10' AND ts < '2024-01-11'")
def half_open_range(t):
    return t.sql(
        "SELECT event_id FROM {events} WHERE ts >= CAST(:low AS TIMESTAMP_NTZ) AND ts < CAST(:high AS TIMESTAMP_NTZ)",
        low="2024-01-10",
        high="2024-01-11",
    )


@query(
    "dat5",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days,
       CAST(date_diff('month', o_orderdate, l_shipdate) AS INTEGER) AS months, CAST(date_diff('year', o_orderdate, l_shipdate) AS INTEGER) AS years,
       date_sub('second', o_orderdate, l_shipdate) AS seconds, date_sub('minute', o_orderdate, l_shipdate) AS minutes FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def date_differences(t):
    a, b = F.col("o_orderdate"), F.col("l_shipdate")
    # Month and year differences count calendar boundaries.
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.datediff(b, a).alias("days"),
        ((F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)).alias("months"),
        (F.year(b) - F.year(a)).alias("years"),
        F.timestamp_diff("SECOND", a, b).alias("seconds"),
        F.timestamp_diff("MINUTE", a, b).alias("minutes"),
    )


@query(
    "dat6",
    """SELECT o_orderkey, strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS week_later, strftime(o_orderdate - INTERVAL 2 MONTH, '%Y-%m-%d') AS months_before,
       strftime(o_orderdate + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS soon FROM orders""",
)
def date_shift(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.date_add(d, 7).cast("string").alias("week_later"),
        F.add_months(d, -2).cast("string").alias("months_before"),
        F.date_format(d + F.expr("INTERVAL 90 MINUTE"), "yyyy-MM-dd HH:mm:ss").alias("soon"),
    )


@query(
    "dat7",
    "SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS year FROM orders",
)
def date_truncate(t):
    return t.orders.select(
        "o_orderkey", F.trunc("o_orderdate", "month").cast("string").alias("month"), F.trunc("o_orderdate", "year").cast("string").alias("year")
    )


@query(
    "dat8",
    """WITH x AS (SELECT event_id, strftime(ts, '%Y-%m-%d %I-%p') AS s FROM events)
       SELECT event_id, s, strftime(strptime(s, '%Y-%m-%d %I-%p'), '%d/%m/%Y %H') AS back, CAST(NULL AS VARCHAR) AS bad FROM x""",
)
def format_and_parse(t):
    s = F.date_format("ts", "yyyy-MM-dd hh-a")
    back = F.to_timestamp("s", "yyyy-MM-dd hh-a")
    bad = F.try_to_timestamp(F.concat("s", F.lit("?")), F.lit("yyyy-MM-dd hh-a"))
    return t.events.select("event_id", s.alias("s")).select(
        "event_id", "s", F.date_format(back, "dd/MM/yyyy HH").alias("back"), F.date_format(bad, "dd/MM/yyyy HH").alias("bad")
    )


@query("dat9")
def now(t):
    recent = t.events.agg(F.max("ts").alias("last_ts"))
    return recent.select("last_ts", F.current_date().alias("today"), F.current_timestamp().alias("at"))


@query(
    "dat10",
    """SELECT event_type, CAST(epoch_us(min(ts)) AS BIGINT) AS lo, CAST(epoch_us(max(ts)) AS BIGINT) AS hi, round(avg(epoch_us(ts)) / 1000000, 2) AS mean_s,
       round(median(epoch_us(ts)) / 1000000, 2) AS median_s, round(stddev_samp(epoch_us(ts) / 1000000 - 1704067200), 4) AS std_s FROM events GROUP BY 1""",
)
def timestamp_stats(t):
    from ..operators.ordered import micros
    from ..operators.quantiles import exact_quantiles

    df = t.events.select("event_type", micros("ts").alias("us"))
    stats = df.groupBy("event_type").agg(
        F.min("us").alias("lo"),
        F.max("us").alias("hi"),
        R(F.avg("us") / 1000000, 2).alias("mean_s"),
        R(F.stddev_samp(F.col("us") / 1000000 - 1704067200), 4).alias("std_s"),
    )
    middle = exact_quantiles(df, "us", {"m": 0.5}, ["event_type"])
    return stats.join(middle.select("event_type", R(F.col("m") / 1000000, 2).alias("median_s")), "event_type")


@query(
    "dat11",
    """WITH d AS (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS n FROM orders)
       SELECT o_orderkey, round(n / 365.25, 8) AS years, round((n / 365.25) / (10000 / 365.25), 8) AS age_ratio FROM d""",
)
def days_to_years(t):
    years = F.datediff(F.lit("2001-12-31").cast("date"), "o_orderdate") / 365.25
    return t.orders.select("o_orderkey", R(years, 8).alias("years"), R(years / F.lit(10000 / 365.25), 8).alias("age_ratio"))


@query(
    "mth1",
    """SELECT p_partkey, CAST(p_size * p_size AS DOUBLE) AS sq, round(sqrt(p_retailprice), 8) AS root, round(exp(p_size / 10.0), 4) AS e, round(CASE WHEN p_size > 25 THEN ln(p_size - 25) END, 8) AS l,
       abs(p_size - 25) AS a, round(p_retailprice / p_size, 6) AS q FROM part""",
)
def arithmetic(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.pow(size, 2).alias("sq"),
        R(F.sqrt("p_retailprice"), 8).alias("root"),
        R(F.exp(size / 10.0), 4).alias("e"),
        R(F.ln(size - 25), 8).alias("l"),  # null at zero and below
        F.abs(size - 25).alias("a"),
        R(F.col("p_retailprice") / size, 6).alias("q"),
    )


@query("mth2", "SELECT p_partkey, round(sin(p_size), 10) AS s, round(cos(p_size), 10) AS c, round(tan(p_size), 8) AS t FROM part")
def trigonometry(t):
    x = F.col("p_size")
    return t.part.select("p_partkey", R(F.sin(x), 10).alias("s"), R(F.cos(x), 10).alias("c"), R(F.tan(x), 8).alias("t"))


@query("mth3", "SELECT p_partkey, round(p_size / 2.0) AS half_up, round_even(p_size / 2.0, 0) AS half_even FROM part")
def rounding(t):
    x = F.col("p_size") / F.lit(2.0)
    return t.part.select("p_partkey", R(x).alias("half_up"), F.bround(x).alias("half_even"))


@query(
    "mth4",
    "SELECT c_custkey, c_custkey % 3 = 0 AS by_three, CAST((c_custkey - 700) % 7 AS BIGINT) AS rem, ((c_custkey - 700) % 7 + 7) % 7 AS pos FROM customer",
)
def modulo(t):
    x = F.col("c_custkey") - 700
    return t.customer.select("c_custkey", (F.col("c_custkey") % 3 == 0).alias("by_three"), (x % 7).alias("rem"), F.pmod(x, F.lit(7)).alias("pos"))


def listing(arr):
    return F.concat_ws(",", F.transform(arr, lambda x: x.cast("string")))


@query(
    "arr1",
    """SELECT p_partkey, array_to_string(range(0, p_size, 5), ',') AS rng, array_to_string(list_transform(range(0, 5), lambda i: CAST(round(i * p_size / 4.0, 2) AS VARCHAR)), ',') AS spaced,
       array_to_string(list_transform(range(0, 4), lambda i: 7), ',') AS full_list, CAST(len(range(0, p_size)) AS INTEGER) AS n FROM part""",
)
def array_build(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        listing(F.sequence(F.lit(0), size - 1, F.lit(5))).alias("rng"),
        listing(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: R(i * size / F.lit(4.0), 2))).alias("spaced"),
        listing(F.array_repeat(F.lit(7), 4)).alias("full_list"),
        F.size(F.sequence(F.lit(0), size - 1)).alias("n"),
    )


@query(
    "arr2",
    """SELECT vec_id, CAST(embedding[64] AS DOUBLE) AS last, CAST(embedding[2] AS DOUBLE) AS second, round(list_sum(list_transform(embedding[2:6:2], lambda x: CAST(x AS DOUBLE))), 8) AS step_sum,
       CAST(list_reverse(embedding)[1] AS DOUBLE) AS reversed_first FROM embeddings""",
)
def array_slices(t):
    e = F.col("embedding")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))
    step = F.filter(F.slice(e, 2, 5), lambda x, i: i % 2 == 0)
    return t.embeddings.select(
        "vec_id",
        F.element_at(e, -1).cast("double").alias("last"),
        F.element_at(e, 2).cast("double").alias("second"),
        R(total(step), 8).alias("step_sum"),
        F.element_at(F.reverse(e), 1).cast("double").alias("reversed_first"),
    )


@query(
    "arr3",
    """WITH x AS (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations), n AS (SELECT conv_id, turn, list_transform(w, lambda s: CAST(length(s) AS INTEGER)) AS a FROM x)
       SELECT conv_id, turn, array_to_string(list_sort(a), ',') AS sorted, CAST(len(list_distinct(a)) AS INTEGER) AS n_distinct, CAST(list_position(a, list_max(a)) AS BIGINT) AS argmax,
       CAST(len(list_filter(a, lambda v: v > 4)) AS INTEGER) AS n_long FROM n""",
)
def array_sort_and_search(t):
    a = F.transform(F.split("text", " "), lambda s: F.length(s))
    return t.conversations.select("conv_id", "turn", a.alias("a")).select(
        "conv_id",
        "turn",
        listing(F.array_sort("a")).alias("sorted"),
        F.size(F.array_distinct("a")).alias("n_distinct"),
        F.array_position("a", F.array_max("a")).alias("argmax"),
        F.size(F.filter("a", lambda v: v > 4)).alias("n_long"),
    )


@query(
    "arr4",
    """SELECT vec_id, CAST(len(list_concat(embedding, embedding[1:8])) AS INTEGER) AS n, round(list_sum(list_transform(embedding[17:32], lambda x: CAST(x AS DOUBLE))), 8) AS second_part,
       CAST(len(flatten([embedding[1:32], embedding[33:64]])) AS INTEGER) AS n_flat, CAST(embedding[9 + 3] AS DOUBLE) AS reshaped_1_3 FROM embeddings""",
)
def array_reshape(t):
    e = F.col("embedding")
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(e, i * 8 + 1, F.lit(8)))
    return t.embeddings.select(
        "vec_id",
        F.size(F.concat(e, F.slice(e, 1, 8))).alias("n"),
        R(F.aggregate(F.slice(e, 17, 16), F.lit(0.0), lambda s, x: s + x.cast("double")), 8).alias("second_part"),
        F.size(F.flatten(F.array(F.slice(e, 1, 32), F.slice(e, 33, 32)))).alias("n_flat"),
        rows[1][3].cast("double").alias("reshaped_1_3"),
    )


@query(
    "arr5",
    """WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings)
       SELECT vec_id, round(list_sum(list_transform(e, lambda v: v + 2)), 8) AS plus_two, round(list_sum(list_transform(e, lambda v: v * v)), 8) AS squares,
       round(list_avg(e), 8) + 0 AS mean, round(list_stddev_pop(e), 8) AS std FROM x""",
)
def array_arithmetic(t):
    df = t.embeddings.select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    mean = add("e") / F.size("e")
    df = df.withColumn("m", mean)
    spread = add(F.transform("e", lambda v: F.pow(v - F.col("m"), 2))) / F.size("e")
    return df.select(
        "vec_id",
        R(add(F.transform("e", lambda v: v + 2)), 8).alias("plus_two"),
        R(add(F.zip_with("e", "e", lambda a, b: a * b)), 8).alias("squares"),
        R("m", 8).alias("mean"),
        R(F.sqrt(spread), 8).alias("std"),
    )


@query(
    "arr6",
    """WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS e FROM embeddings)
       SELECT vec_id, round(sqrt(list_dot_product(e, e)), 8) AS norm, round(list_dot_product(e, list_reverse(e)), 8) + 0 AS dot FROM x""",
)
def norm_and_dot(t):
    df = t.embeddings.select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return df.select("vec_id", R(F.sqrt(dot("e", "e")), 8).alias("norm"), R(dot("e", F.reverse("e")), 8).alias("dot"))


CELLS = "m AS (SELECT vec_id AS i, unnest(range(0, 64)) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)"


def cells(t):
    return t.embeddings.select(F.col("vec_id").alias("i"), F.posexplode("embedding").alias("j", "x")).select(
        "i", F.col("j").cast("bigint").alias("j"), F.col("x").cast("double").alias("v")
    )


@query(
    "arr7",
    f"WITH {CELLS} SELECT a.j AS i, b.j AS j, round(sum(a.v * b.v), 6) + 0 AS v FROM m a JOIN m b ON a.i = b.i GROUP BY 1, 2",
)
def matrix_product(t):
    # Transpose times itself: every vector gives its 64 x 64 products, summed on the way to the shuffle.
    row = t.embeddings.select(F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    left = row.select("e", F.posexplode("e").alias("i", "a"))
    both = left.select("i", "a", F.posexplode("e").alias("j", "b"))
    return both.groupBy(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j")).agg(
        R(F.sum(F.col("a") * F.col("b")), 6).alias("v")
    )


@query(
    "arr7_trace",
    f"WITH {CELLS} SELECT round(sum(v) FILTER (i = j), 8) AS trace, count(*) FILTER (i = j) AS n_diag, max(v) FILTER (j = 3) AS row3_max FROM m",
)
def matrix_trace(t):
    flipped = cells(t).select(F.col("j").alias("i"), F.col("i").alias("j"), "v")
    diag = F.col("i") == F.col("j")
    return flipped.agg(
        R(F.sum(F.when(diag, F.col("v"))), 8).alias("trace"),
        F.count_if(diag).alias("n_diag"),
        F.max(F.when(F.col("i") == 3, F.col("v"))).alias("row3_max"),
    )


@query("nst1", "SELECT event_id, event_type AS name, CAST(hour(ts) AS INTEGER) AS h, value AS path FROM events")
def nested_access(t):
    nested = t.events.select(
        "event_id",
        F.struct(F.col("event_type").alias("name"), F.struct(F.hour("ts").alias("h")).alias("at")).alias("committer"),
        F.struct(F.struct(F.col("value").alias("path")).alias("page")).alias("hits"),
    )
    return nested.select("event_id", "committer.name", "committer.at.h", "hits.page.path")


@query(
    "nst2",
    r"""SELECT doc_id, unnest(list_filter(string_split(text, chr(10)), lambda s: length(s) > 0)) AS line FROM documents""",
)
def unnest_array(t):
    # Rows whose array is empty drop out.
    lines = F.filter(F.split("text", "\n"), lambda s: F.length(s) > 0)
    return t.documents.select("doc_id", F.explode(lines).alias("line"))


LANGS = """x AS (SELECT p_partkey, unnest([{'name': p_type, 'bytes': CAST(p_size AS BIGINT)}, {'name': p_brand, 'bytes': CAST(floor(p_retailprice) AS BIGINT)}]) AS l FROM part)"""


def languages(t):
    """A table with a repeated record: the names and sizes of one row."""
    item = lambda name, size: F.struct(F.col(name).alias("name"), size.cast("bigint").alias("bytes"))
    return t.part.select(
        "p_partkey", F.array(item("p_type", F.col("p_size")), item("p_brand", F.floor("p_retailprice"))).alias("language")
    )


@query("nst3", f"WITH {LANGS} SELECT l.name AS language_name, count(*) AS num_repos, CAST(sum(l.bytes) AS BIGINT) AS total FROM x WHERE l.bytes > 10 GROUP BY 1")
def unnest_structs(t):
    flat = languages(t).select("p_partkey", F.explode("language").alias("l"))
    return (
        flat.filter("l.bytes > 10")
        .groupBy(F.col("l.name").alias("language_name"))
        .agg(F.count(F.lit(1)).alias("num_repos"), F.sum("l.bytes").alias("total"))
        .orderBy(F.desc("num_repos"))
    )


@query(
    "nst4",
    """WITH x AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'click') AS a, count(*) FILTER (event_type = 'view') AS b, count(*) FILTER (event_type = 'error') AS missing FROM events GROUP BY 1)
       SELECT user_id, greatest(a, b) AS top, round(greatest(a, b, missing) / n, 8) AS share FROM x""",
)
def map_values(t):
    kind = F.col("event_type")
    x = t.events.groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.create_map(F.lit("click"), F.count_if(kind == "click"), F.lit("view"), F.count_if(kind == "view")).alias("counts"),
        F.count_if(kind == "error").alias("missing"),
    )
    top = F.coalesce(F.array_max(F.map_values("counts")), F.lit(0))
    return x.select("user_id", top.alias("top"), R(F.greatest(top, "missing") / F.col("n"), 8).alias("share"))


@query("nst5", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text FROM events")
def json_columns(t):
    return t.events.select(
        "event_id", F.from_json("props", "k BIGINT")["k"].alias("k"), F.get_json_object("props", "$.k").alias("k_text")
    )


@query("rnd1")
def random_rows(t):
    # A hash of the key gives the same sample and the same shuffle under any partitioning.
    df = t.orders.select("o_orderkey", stable_hash("o_orderkey", seed=42).alias("h"))
    sample = df.filter(F.pmod("h", F.lit(100)) < 10)
    return ordered(sample, Ordered(order="h", tie=["o_orderkey"], row_number="position")).drop("h")


@query("rnd1_columns")
def random_columns(t):
    u = (F.pmod(stable_hash("o_orderkey", seed=7), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    v = (F.pmod(stable_hash("o_orderkey", seed=8), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    normal = F.sqrt(-2 * F.ln(u)) * F.cos(2 * F.pi() * v)
    return t.orders.select("o_orderkey", u.alias("uniform"), normal.alias("normal"), F.floor(u * 6 + 1).alias("die"))


@query("rnd1_replace")
def sample_with_replacement(t):
    return t.orders.sample(withReplacement=True, fraction=0.1, seed=42).select("o_orderkey")
