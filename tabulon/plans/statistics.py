"""Statistics on tables."""

from pyspark.sql import functions as F

from ..operators import stats as St
from ..operators.aggregate import levels, most_frequent
from ..operators.quantiles import exact_quantiles, with_quantiles
from ..registry import query
from ..sources.scratch import durable

R = F.round


@query(
    "sta1",
    """WITH s AS (SELECT count(l_quantity)::DOUBLE AS "count", avg(l_quantity) AS mean, median(l_quantity) AS median,
         (SELECT l_quantity FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode, min(l_quantity) AS "min", max(l_quantity) AS "max",
         max(l_quantity) - min(l_quantity) AS "range", var_samp(l_quantity) AS variance, stddev_samp(l_quantity) AS standard_deviation,
         quantile_cont(l_quantity, 0.25) AS "Q1", quantile_cont(l_quantity, 0.75) AS "Q3", quantile_cont(l_quantity, 0.75) - quantile_cont(l_quantity, 0.25) AS "IQR",
         quantile_cont(l_quantity, 0.9) AS "90th_percentile" FROM lineitem)
       SELECT statistic, round(value, 8) AS value FROM s UNPIVOT (value FOR statistic IN ("count", mean, median, mode, "min", "max", "range", variance, standard_deviation, "Q1", "Q3", "IQR", "90th_percentile"))""",
)
def summary_table(t):
    x = "l_quantity"
    wide = t.lineitem.agg(
        F.count(x).cast("double").alias("count"),
        F.avg(x).alias("mean"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        (F.max(x) - F.min(x)).alias("range"),
        F.var_samp(x).alias("variance"),
        F.stddev_samp(x).alias("standard_deviation"),
    )
    probs = {"Q1": 0.25, "median": 0.5, "Q3": 0.75, "90th_percentile": 0.9}
    q = exact_quantiles(t.lineitem, x, probs).select(F.struct(*probs).alias("q")).scalar()
    mode = most_frequent(t.lineitem, [], x, "mode").scalar()
    full = wide.withColumns({"_q": q, "mode": mode}).withColumns(
        {**{n: F.col(f"_q.`{n}`") for n in probs}, "IQR": F.col("_q.Q3") - F.col("_q.Q1")}
    )
    names = [c for c in full.columns if c != "_q"]
    return full.unpivot([], names, "statistic", "value").withColumn("value", R("value", 8))


@query(
    "sta2",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
       SELECT event_id, value, round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper FROM events JOIN q USING (event_type)
       WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def outliers(t):
    fenced = St.iqr_bounds(t.events.select("event_id", "event_type", "value"), "value", ["event_type"])
    return fenced.filter((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).select(
        "event_id", "value", R("lower", 6).alias("lower"), R("upper", 6).alias("upper")
    )


@query(
    "sta3",
    " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_samp(value), 6) AS std FROM events {w}"
        for n, w in (("with_outlier", ""), ("normal_values", "WHERE value < 30"))
    ),
)
def with_and_without(t):
    names = F.when(F.col("value") < 30, F.array(F.lit("with_outlier"), F.lit("normal_values"))).otherwise(F.array(F.lit("with_outlier")))
    both = t.events.select("value", F.explode(names).alias("dataset"))
    stats = both.groupBy("dataset").agg(R(F.avg("value"), 6).alias("mean"), R(F.stddev_samp("value"), 6).alias("std"))
    middle = exact_quantiles(both, "value", {"m": 0.5}, ["dataset"])
    return stats.join(middle.select("dataset", R("m", 6).alias("median")), "dataset")


FIVE = {"lo": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "hi": 1.0}


@query(
    "sta4",
    "SELECT event_type, " + ", ".join(f"round(quantile_cont(value, {p}), 6) AS {n}" for n, p in FIVE.items()) + " FROM events GROUP BY 1",
)
def five_numbers(t):
    q = exact_quantiles(t.events, "value", FIVE, ["event_type"])
    return q.select("event_type", *[R(n, 6).alias(n) for n in FIVE])


@query(
    "sta5",
    """WITH e AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents)
       SELECT CAST(least(floor((n_chars - lo) / (hi - lo) * 30), 29) AS BIGINT) AS bin, count(*) AS n FROM documents, e GROUP BY 1""",
)
def histogram_counts(t):
    return St.histogram(t.documents, "n_chars", 30)


@query(
    "sta6",
    """SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 8) AS pearson, round(covar_samp(l_quantity, l_extendedprice), 4) AS cov, round(covar_pop(l_quantity, l_extendedprice), 4) AS cov_pop
       FROM lineitem GROUP BY 1""",
)
def correlation(t):
    a, b = "l_quantity", "l_extendedprice"
    return t.lineitem.groupBy("l_returnflag").agg(
        R(F.corr(a, b), 8).alias("pearson"), R(F.covar_samp(a, b), 4).alias("cov"), R(F.covar_pop(a, b), 4).alias("cov_pop")
    )


@query(
    "sta7",
    """SELECT l_returnflag, round(var_pop(l_quantity), 8) AS vp, round(var_samp(l_quantity), 8) AS vs, round(stddev_pop(l_quantity), 8) AS sp, round(stddev_samp(l_quantity), 8) AS ss,
       round(stddev_samp(l_quantity) / avg(l_quantity), 8) AS cv FROM lineitem GROUP BY 1""",
)
def spread(t):
    x = "l_quantity"
    return t.lineitem.groupBy("l_returnflag").agg(
        R(F.var_pop(x), 8).alias("vp"),
        R(F.var_samp(x), 8).alias("vs"),
        R(F.stddev_pop(x), 8).alias("sp"),
        R(F.stddev_samp(x), 8).alias("ss"),
        R(F.stddev_samp(x) / F.avg(x), 8).alias("cv"),
    )


@query(
    "sta8",
    """SELECT o_orderkey, round((o_totalprice - m) / nullif(s, 0), 8) + 0 AS z FROM orders JOIN (SELECT o_orderpriority, avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders GROUP BY 1) USING (o_orderpriority)""",
)
def z_scores(t):
    x = F.col("o_totalprice")
    m = durable(t.orders.groupBy("o_orderpriority").agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")))
    return t.orders.join(m, "o_orderpriority").select("o_orderkey", R((x - F.col("m")) / F.nullif(F.col("s"), F.lit(0)), 8).alias("z"))


@query(
    "sta9",
    """WITH a AS (SELECT *, median(value) OVER (PARTITION BY event_type) AS med FROM events), b AS (SELECT *, abs(value - med) AS dev FROM a),
       c AS (SELECT *, median(dev) OVER (PARTITION BY event_type) AS mad FROM b) SELECT event_id, round(0.6745 * (value - med) / nullif(mad, 0), 6) + 0 AS robust_z FROM c""",
)
def robust_scores(t):
    z = St.robust_z(t.events.select("event_id", "event_type", "value"), "value", ["event_type"])
    return z.select("event_id", R("robust_z", 6).alias("robust_z"))


@query(
    "sta10",
    """SELECT round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events""",
)
def tail_percentiles(t):
    names = {"median": 0.5, "p95": 0.95, "p99": 0.99}
    mean = t.events.agg(F.avg("value")).scalar()
    q = exact_quantiles(t.events, "value", names)
    return q.select(R(mean, 6).alias("mean"), *[R(n, 6).alias(n) for n in names])


@query(
    "sta11",
    """WITH m AS (SELECT event_type, count(value) AS n, avg(value) AS mu FROM events GROUP BY 1),
       c AS (SELECT event_type, n, avg(pow(value - mu, 2)) AS m2, avg(pow(value - mu, 3)) AS m3, avg(pow(value - mu, 4)) AS m4 FROM events JOIN m USING (event_type) GROUP BY 1, 2)
       SELECT event_type, round(m3 / pow(m2, 1.5), 6) AS skew_pop, round(m4 / (m2 * m2) - 3, 6) AS kurt_pop,
       round(m3 / pow(m2, 1.5) * sqrt(n * (n - 1)) / (n - 2), 6) AS skew_sample, round((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (m4 / (m2 * m2) - 3) + 6), 6) AS kurt_sample FROM c""",
)
def shape(t):
    return t.events.groupBy("event_type").agg(
        R(F.skewness("value"), 6).alias("skew_pop"),
        R(F.kurtosis("value"), 6).alias("kurt_pop"),
        R(St.sample_skewness("value"), 6).alias("skew_sample"),
        R(St.sample_kurtosis("value"), 6).alias("kurt_sample"),
    )


@query(
    "sta12",
    """WITH c AS (SELECT l_quantity AS x, count(*) / (SELECT count(*) FROM lineitem) AS p FROM lineitem GROUP BY 1), m AS (SELECT sum(x * p) AS mu FROM c)
       SELECT round(max(mu), 8) AS mean, round(sum(pow(x - mu, 2) * p), 8) AS variance FROM c, m""",
)
def discrete_moments(t):
    n = t.lineitem.agg(F.count("*")).scalar()
    c = t.lineitem.groupBy(F.col("l_quantity").alias("x")).agg((F.count("*") / n).alias("p"))
    mu = c.agg(F.sum(F.col("x") * F.col("p"))).scalar()
    return c.withColumn("mu", mu).agg(
        R(F.max("mu"), 8).alias("mean"), R(F.sum(F.pow(F.col("x") - F.col("mu"), 2) * F.col("p")), 8).alias("variance")
    )


@query(
    "sta13",
    """WITH u AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS k, avg(value) AS v FROM events GROUP BY 1),
       z AS (SELECT *, (k - n * 0.2) / sqrt(n * 0.16) AS z FROM u), w AS (SELECT *, 1 / (1 + 0.2316419 * abs(z)) AS t FROM z),
       x AS (SELECT *, exp(-z * z / 2) / sqrt(2 * pi()) * (0.319381530 * t - 0.356563782 * t * t + 1.781477937 * pow(t, 3) - 1.821255978 * pow(t, 4) + 1.330274429 * pow(t, 5)) AS up FROM w)
       SELECT user_id, round(exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(0.2) + (n - k) * ln(0.8)), 8) AS binomial,
       round((SELECT sum(exp(i * ln(2) - 2 - lgamma(i + 1))) FROM range(0, k + 1) r(i)), 8) AS poisson,
       round(CASE WHEN z >= 0 THEN up ELSE 1 - up END, 8) AS normal_tail, round(exp(-0.2 * v), 8) AS exponential_tail FROM x""",
)
def probabilities(t):
    users = t.events.groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("k"), F.avg("value").alias("v")
    )
    return users.select(
        "user_id",
        R(St.binomial_pmf(F.col("k"), F.col("n"), 0.2), 8).alias("binomial"),
        R(St.poisson_cdf(F.col("k"), 2.0), 8).alias("poisson"),
        R(St.normal_tail((F.col("k") - F.col("n") * 0.2) / F.sqrt(F.col("n") * 0.16)), 8).alias("normal_tail"),
        R(St.exponential_tail(F.col("v"), 0.2), 8).alias("exponential_tail"),
    )


@query(
    "sta14",
    """WITH c AS (SELECT o_orderpriority AS g, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS k FROM orders GROUP BY 1),
       l AS (SELECT g, i / 100.0 AS p, k * ln(i / 100.0) + (n - k) * ln(1 - i / 100.0) AS ll FROM c, range(1, 100) r(i))
       SELECT g, CAST(arg_max(p, ll) AS DOUBLE) AS best_p FROM l GROUP BY 1""",
)
def grid_likelihood(t):
    c = t.orders.groupBy(F.col("o_orderpriority").alias("g")).agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("k")
    )
    p = F.transform(F.sequence(F.lit(1), F.lit(99)), lambda i: i / F.lit(100.0))
    grid = c.withColumn("p", F.explode(p))
    ll = F.col("k") * F.ln("p") + (F.col("n") - F.col("k")) * F.ln(1 - F.col("p"))
    return grid.groupBy("g").agg(F.max_by("p", ll).alias("best_p"))


@query(
    "sta15",
    """WITH c AS (SELECT lang, avg(quality = 0 AND true) AS x, count(*) AS n, count(*) FILTER (toxic = 1) AS bad, count(*) FILTER (toxic = 1 AND quality = 0) AS hit, count(*) FILTER (toxic = 0 AND quality = 0) AS fp
       FROM labels JOIN documents USING (doc_id) GROUP BY 1), r AS (SELECT lang, bad / n AS prior, hit / nullif(bad, 0) AS sens, fp / nullif(n - bad, 0) AS fpr FROM c)
       SELECT lang, round(prior, 8) AS prior, round(sens, 8) AS sensitivity, round(fpr, 8) AS false_positive_rate, round(sens * prior / nullif(sens * prior + fpr * (1 - prior), 0), 8) AS posterior FROM r""".replace(
        "avg(quality = 0 AND true) AS x, ", ""
    ),
)
def posterior(t):
    toxic, flagged = F.col("toxic") == 1, F.col("quality") == 0
    c = (
        t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
        .groupBy("lang")
        .agg(
            F.count("*").alias("n"),
            F.count_if(toxic).alias("bad"),
            F.count_if(toxic & flagged).alias("hit"),
            F.count_if(~toxic & flagged).alias("fp"),
        )
    )
    prior = F.col("bad") / F.col("n")
    sens = F.col("hit") / F.nullif(F.col("bad"), F.lit(0))
    fpr = F.col("fp") / F.nullif(F.col("n") - F.col("bad"), F.lit(0))
    post = sens * prior / F.nullif(sens * prior + fpr * (1 - prior), F.lit(0))
    return c.select(
        "lang", R(prior, 8).alias("prior"), R(sens, 8).alias("sensitivity"), R(fpr, 8).alias("false_positive_rate"), R(post, 8).alias("posterior")
    )


@query(
    "sta16",
    """SELECT event_type, round(avg(value), 8) AS mean, round(stddev_samp(value) / sqrt(count(value)), 8) AS se, round(avg(value) - 1.96 * stddev_samp(value) / sqrt(count(value)), 8) AS low,
       round(avg(value) + 1.96 * stddev_samp(value) / sqrt(count(value)), 8) AS high FROM events GROUP BY 1""",
)
def interval(t):
    m = St.moments(t.events, ["event_type"], "value").withColumn("se", F.col("std") / F.sqrt("n"))
    return m.select(
        "event_type",
        R("mean", 8).alias("mean"),
        R("se", 8).alias("se"),
        R(F.col("mean") - 1.96 * F.col("se"), 8).alias("low"),
        R(F.col("mean") + 1.96 * F.col("se"), 8).alias("high"),
    )


@query("sta17")
def bootstrap(t):
    return St.bootstrap_means(t.events, "event_id", "value", 100)


PAIRS = """m AS (SELECT event_type AS g, count(value) AS n, avg(value) AS mean, var_samp(value) AS v FROM events GROUP BY 1),
  p AS (SELECT a.g AS g_a, b.g AS g_b, a.n AS na, b.n AS nb, a.mean AS ma, b.mean AS mb, a.v AS va, b.v AS vb FROM m a JOIN m b ON a.g = (SELECT min(g) FROM m) AND a.g < b.g)"""


def pairs(t, control: str | None = None):
    """The moments of a control group (the first event type if none is named) beside those of every other group: one row per group."""
    m = St.moments(t.events, ["event_type"], "value")
    first = F.lit(control) if control is not None else t.events.agg(F.min("event_type")).scalar()
    a = m.filter(F.col("event_type") == first).select(F.struct(*m.columns).alias("a")).agg(F.first("a").alias("a")).scalar()
    rows = m.withColumn("a", a).filter(F.col("event_type") != F.col("a.event_type"))
    return rows.select(*[F.col(f"a.{c}").alias(f"{c}_a") for c in m.columns], *[F.col(c).alias(f"{c}_b") for c in m.columns])


@query(
    "sta18",
    f"""WITH {PAIRS} SELECT g_a, g_b, round((ma - mb) / sqrt(va / na + vb / nb), 6) + 0 AS t, round(pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1)), 4) AS df FROM p""",
)
def welch_test(t):
    stat, df = St.welch("_a", "_b")
    return pairs(t).select(F.col("event_type_a").alias("g_a"), F.col("event_type_b").alias("g_b"), R(stat, 6).alias("t"), R(df, 4).alias("df"))


@query(
    "sta18_p",
    f"""WITH {PAIRS}, s AS (SELECT g_a AS event_type_a, g_b AS event_type_b, abs((ma - mb) / sqrt(va / na + vb / nb)) AS z FROM p), w AS (SELECT *, 1 / (1 + 0.2316419 * z) AS t FROM s)
        SELECT event_type_a, event_type_b, round(2 * exp(-z * z / 2) / sqrt(2 * pi()) * (0.319381530 * t - 0.356563782 * t * t + 1.781477937 * pow(t, 3) - 1.821255978 * pow(t, 4) + 1.330274429 * pow(t, 5)), 7) AS p_value FROM w""",
)
def welch_p_value(t):
    stat, df = St.welch("_a", "_b")
    return pairs(t).select("event_type_a", "event_type_b", R(2 * St.normal_tail(F.abs(stat)), 7).alias("p_value"))


@query(
    "sta19",
    f"""WITH {PAIRS} SELECT g_a, g_b, round(mb - ma, 8) + 0 AS mean_difference, round((mb - ma) / ma, 8) + 0 AS relative_lift,
        round((mb - ma) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)), 8) + 0 AS cohens_d FROM p""",
)
def effect_size(t):
    diff = F.col("mean_b") - F.col("mean_a")
    return pairs(t).select(
        F.col("event_type_a").alias("g_a"),
        F.col("event_type_b").alias("g_b"),
        R(diff, 8).alias("mean_difference"),
        R(diff / F.col("mean_a"), 8).alias("relative_lift"),
        R(St.cohens_d("_a", "_b"), 8).alias("cohens_d"),
    )


@query(
    "sta20",
    """WITH p AS (SELECT l_suppkey, avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) / 20 AS p FROM lineitem GROUP BY 1),
       r AS (SELECT *, count(*) OVER () AS m, row_number() OVER (ORDER BY p, l_suppkey) AS rk FROM p)
       SELECT l_suppkey, round(p, 10) AS p, round(least(p * m, 1), 8) AS bonferroni,
       round(least(min(p * m / rk) OVER (ORDER BY rk DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1), 8) AS benjamini_hochberg,
       round(1 - pow(0.95, m), 8) AS any_false_positive FROM r""",
)
def corrections(t):
    p = t.lineitem.groupBy("l_suppkey").agg((F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)) / 20).alias("p"))
    m = t.lineitem.agg(F.count_distinct("l_suppkey")).scalar()
    out = St.adjust_p_values(p, "p", "l_suppkey")
    return out.select(
        "l_suppkey",
        R("p", 10).alias("p"),
        R("bonferroni", 8).alias("bonferroni"),
        R("benjamini_hochberg", 8).alias("benjamini_hochberg"),
        R(1 - F.pow(F.lit(0.95), m), 8).alias("any_false_positive"),
    )
