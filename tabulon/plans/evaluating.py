"""Evaluation of scores, thresholds, blends and importance tables."""

from pyspark.sql import functions as F

from ..operators import evaluate as V
from ..registry import query

R = F.round
SCORED = """s AS (SELECT doc_id, quality AS y, round(n_chars / (n_chars + 2000.0), 3) AS p, round((doc_id % 97) / 97.0, 3) AS b, doc_id % 3 AS fold FROM labels JOIN documents USING (doc_id))"""
CURVE = """g AS (SELECT p AS threshold, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM s GROUP BY 1),
  c AS (SELECT threshold, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp, CAST(sum(pos) OVER () AS BIGINT) AS pp, CAST(sum(neg) OVER () AS BIGINT) AS nn FROM g WINDOW w AS (ORDER BY threshold DESC)),
  m AS (SELECT *, tp / (tp + fp) AS pr, tp / pp AS rc FROM c), f AS (SELECT *, coalesce(2 * pr * rc / nullif(pr + rc, 0), 0) AS f1 FROM m)"""


def scored(t):
    """Label, two scores in [0, 1] and a fold per document. The first score comes from the text length."""
    n = F.col("n_chars")
    d = t.documents.select("doc_id", R(n / (n + 2000.0), 3).alias("p"), R((F.col("doc_id") % 97) / 97.0, 3).alias("b"), (F.col("doc_id") % 3).alias("fold"))
    return t.labels.select("doc_id", F.col("quality").alias("y")).join(d, "doc_id")


def curve(t):
    return V.score_curve(scored(t), "p", "y")


@query(
    "evl1",
    f"""WITH {SCORED}, g AS (SELECT a, b FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) z(b))
        SELECT a AS actual, g.b AS predicted, count(y) AS n FROM g LEFT JOIN s ON y = a AND CAST(p >= 0.4 AS INTEGER) = g.b GROUP BY 1, 2""",
)
def confusion_matrix(t):
    return V.confusion(scored(t), "y", V.predicted("p", 0.4))


@query(
    "evl2",
    f"""WITH {SCORED}, c AS (SELECT count(*) FILTER (y = 1 AND p >= 0.4) AS tp, count(*) FILTER (y = 0 AND p >= 0.4) AS fp, count(*) FILTER (y = 0 AND p < 0.4) AS tn, count(*) FILTER (y = 1 AND p < 0.4) AS fn FROM s)
        SELECT round((tp + tn) / (tp + fp + tn + fn), 10) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 10) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 10) AS recall,
        round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 10) AS f1 FROM c""",
)
def basic_metrics(t):
    m = V.class_metrics(V.counts_at(scored(t), "y", V.predicted("p", 0.4)))
    return m.select(*[R(c, 10).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query(
    "evl3",
    f"""WITH {SCORED}, c AS (SELECT count(*) FILTER (y = 1 AND p >= 0.4) AS tp, count(*) FILTER (y = 0 AND p >= 0.4) AS fp, count(*) FILTER (y = 0 AND p < 0.4) AS tn, count(*) FILTER (y = 1 AND p < 0.4) AS fn FROM s),
        k AS (SELECT '0' AS label, tn / (tn + fn) AS pr, tn / (tn + fp) AS rc, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS sup FROM c UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c),
        a AS (SELECT label, pr, rc, f, sup FROM k UNION ALL SELECT 'macro avg', avg(pr), avg(rc), avg(f), sum(sup) FROM k UNION ALL SELECT 'weighted avg', sum(pr * sup) / sum(sup), sum(rc * sup) / sum(sup), sum(f * sup) / sum(sup), sum(sup) FROM k
        UNION ALL SELECT 'accuracy', (tp + tn) / (tp + fp + tn + fn), (tp + tn) / (tp + fp + tn + fn), (tp + tn) / (tp + fp + tn + fn), tp + fp + tn + fn FROM c)
        SELECT label, round(pr, 8) AS "precision", round(rc, 8) AS recall, round(f, 8) AS f1, CAST(sup AS BIGINT) AS support FROM a""",
)
def class_report(t):
    out = V.report(scored(t), "y", V.predicted("p", 0.4))
    return out.select("label", *[R(c, 8).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "evl4",
    f"WITH {SCORED}, n AS (SELECT p, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM s GROUP BY 1) SELECT round(sum(a.pos * CASE WHEN b.p < a.p THEN b.neg WHEN b.p = a.p THEN b.neg / 2 ELSE 0 END) / ((SELECT sum(pos) FROM n) * (SELECT sum(neg) FROM n)), 10) AS roc_auc FROM n a, n b",
)
def roc_auc(t):
    return V.auc_ap(curve(t)).select(R("roc_auc", 10).alias("roc_auc"))


@query("evl5", f"WITH {SCORED}, {CURVE} SELECT round(sum(pos / pp * pr), 10) AS average_precision FROM m")
def average_precision(t):
    return V.auc_ap(curve(t)).select(R("average_precision", 10).alias("average_precision"))


@query(
    "evl6",
    f'WITH {SCORED}, {CURVE} SELECT threshold, round(fp / nn, 10) AS fpr, round(rc, 10) AS recall, round(pr, 10) AS "precision" FROM m',
)
def curve_points(t):
    return V.rates(curve(t)).select("threshold", *[R(c, 10).alias(c) for c in ("fpr", "recall", "precision")])


def threshold_sql(where, order):
    return f'SELECT threshold, round(pr, 10) AS "precision", round(rc, 10) AS recall, round(f1, 10) AS f1 FROM f {where} ORDER BY {order}, threshold DESC LIMIT 1'


def rounded_point(df):
    return df.select("threshold", *[R(c, 10).alias(c) for c in ("precision", "recall", "f1")])


@query("evl7", f"WITH {SCORED}, {CURVE} {threshold_sql('', 'f1 DESC')}")
def threshold_by_f1(t):
    return rounded_point(V.best_threshold(curve(t)))


@query("evl7_floor", f"WITH {SCORED}, {CURVE} {threshold_sql('WHERE pr >= 0.86', 'rc DESC, f1 DESC')}")
def threshold_by_recall(t):
    return rounded_point(V.best_threshold(curve(t), min_precision=0.86))


@query("evl7_fallback", f"WITH {SCORED}, {CURVE} {threshold_sql('', 'f1 DESC')}")
def threshold_fallback(t):
    return rounded_point(V.best_threshold(curve(t), min_precision=1.1))


@query(
    "evl8",
    f"WITH {SCORED}, {CURVE}, k AS (SELECT threshold, 100.0 * (pp - tp) + 10.0 * fp AS cost FROM c) SELECT threshold, CAST(cost AS DOUBLE) AS cost, cost = (SELECT min(cost) FROM k) AS cheapest FROM k",
)
def threshold_costs(t):
    costs = V.cost_curve(curve(t))
    return costs.withColumn("cheapest", F.col("cost") == costs.agg(F.min("cost")).scalar())


@query(
    "evl9",
    f"WITH {SCORED} SELECT CAST(least(floor(p * 5), 4) AS BIGINT) AS bin, count(*) AS n, round(avg(p), 10) AS mean_score, round(avg(y), 10) AS positive_rate FROM s GROUP BY 1",
)
def calibration_bins(t):
    return V.calibration(scored(t), "p", "y", 5).select("bin", "n", R("mean_score", 10).alias("mean_score"), R("positive_rate", 10).alias("positive_rate"))


@query(
    "evl10",
    f"""WITH {SCORED}, q AS (SELECT y, p, least(greatest(p, 1e-15), 1 - 1e-15) AS c FROM s)
        SELECT round(avg(pow(p - y, 2)), 10) AS brier, round(avg(-(y * ln(c) + (1 - y) * ln(1 - c))), 10) AS log_loss FROM q""",
)
def probability_losses(t):
    return V.brier_and_log_loss(scored(t), "p", "y").select(R("brier", 10).alias("brier"), R("log_loss", 10).alias("log_loss"))


@query(
    "evl11",
    """WITH e AS (SELECT l_extendedprice AS y, l_quantity * 1100 AS g FROM lineitem) SELECT round(avg(abs(y - g)), 4) AS mae, round(avg(pow(y - g, 2)), 2) AS mse, round(sqrt(avg(pow(y - g, 2))), 6) AS rmse,
       round(1 - sum(pow(y - g, 2)) / sum(pow(y - (SELECT avg(y) FROM e), 2)), 8) AS r2 FROM e""",
)
def regression(t):
    df = t.lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1100).alias("g"))
    m = V.regression_metrics(df, "y", "g")
    return m.select(R("mae", 4).alias("mae"), R("mse", 2).alias("mse"), R("rmse", 6).alias("rmse"), R("r2", 8).alias("r2"))


GAINS = """g AS (SELECT concat(p_type, '_', p_brand) AS feature, p_type AS src, CAST(sum(CASE WHEN p_size > 20 THEN p_size ELSE 0 END) AS BIGINT) AS gain FROM part GROUP BY 1, 2)"""


def gains(t):
    """An importance table: encoded features of a source column with their gain."""
    return t.part.groupBy(F.concat("p_type", F.lit("_"), "p_brand").alias("feature"), F.col("p_type").alias("src")).agg(
        F.sum(F.when(F.col("p_size") > 20, F.col("p_size")).otherwise(0)).alias("gain")
    )


@query(
    "evl17",
    f"""WITH {GAINS} SELECT src AS source_column, CAST(sum(gain) AS BIGINT) AS total_gain, max(gain) AS max_gain, count(*) AS feature_count, count(*) FILTER (gain > 0) AS positive_count,
        round(sum(gain) / (SELECT sum(gain) FROM g), 10) AS gain_share FROM g GROUP BY 1""",
)
def gain_by_source(t):
    out = V.importance_table(gains(t), "src", "gain")
    return out.withColumn("gain_share", R("gain_share", 10)).orderBy(F.desc("total_gain"))


@query(
    "evl18",
    """WITH c AS (SELECT concat(p_type, '_', p_brand) AS feature, avg(p_size) - 25 AS coefficient FROM part GROUP BY 1)
       SELECT feature, round(coefficient, 10) AS coefficient, round(abs(coefficient), 10) AS size, CASE WHEN coefficient > 0 THEN 'increases' WHEN coefficient < 0 THEN 'decreases' ELSE 'none' END AS direction,
       round(exp(least(greatest(coefficient, -20), 20)), 4) AS odds_multiplier FROM c ORDER BY abs(coefficient) DESC, feature LIMIT 25""",
)
def coefficients(t):
    c = t.part.groupBy(F.concat("p_type", F.lit("_"), "p_brand").alias("feature")).agg((F.avg("p_size") - 25).alias("c"))
    out = V.coefficient_table(c, "feature", "c")
    return out.select("feature", R("coefficient", 10).alias("coefficient"), R("size", 10).alias("size"), "direction", R("odds_multiplier", 4).alias("odds_multiplier"))


@query(
    "evl20",
    """WITH a AS (SELECT p_brand AS feature, sum(p_size) / 100000.0 AS gain FROM part WHERE p_type <> 'PROMO' AND p_brand <> 'Brand#3' GROUP BY 1),
       b AS (SELECT p_brand AS feature, count(*) / 10000.0 AS perm FROM part WHERE p_type = 'PROMO' AND p_brand <> 'Brand#4' GROUP BY 1),
       j AS (SELECT coalesce(a.feature, b.feature) AS feature, coalesce(gain, 0) AS gain, coalesce(perm, 0) AS perm FROM a FULL JOIN b ON a.feature = b.feature),
       k AS (SELECT *, rank() OVER (ORDER BY gain DESC) AS gr, rank() OVER (ORDER BY perm DESC) AS mr FROM j)
       SELECT feature, round(gain, 10) AS gain, round(perm, 10) AS perm, CAST(gr AS INTEGER) AS gain_rank, CAST(mr AS INTEGER) AS perm_rank, (perm <= 0.0012 OR gain <= 0.015) AND feature NOT IN ('Brand#1', 'Brand#4') AS weak FROM k""",
)
def weak_features(t):
    part = t.part.withColumnRenamed("p_brand", "feature")
    a = part.filter("p_type <> 'PROMO' AND feature <> 'Brand#3'").groupBy("feature").agg((F.sum("p_size") / 100000.0).alias("gain"))
    b = part.filter("p_type = 'PROMO' AND feature <> 'Brand#4'").groupBy("feature").agg((F.count("*") / 10000.0).alias("perm"))
    both = V.combine_importances(a, b, "feature", "gain", "perm")
    weak = ((F.col("perm") <= 0.0012) | (F.col("gain") <= 0.015)) & ~F.col("feature").isin("Brand#1", "Brand#4")
    return both.select("feature", R("gain", 10).alias("gain"), R("perm", 10).alias("perm"), "gain_rank", "perm_rank", weak.alias("weak"))


@query(
    "evl22",
    f"""WITH {SCORED}, x AS (SELECT w.w AS weight, fold, y, w.w * p + (1 - w.w) * b AS z FROM s, (VALUES (0.5::DOUBLE), (0.6::DOUBLE), (0.7::DOUBLE), (0.8::DOUBLE)) w(w)),
        n AS (SELECT weight, fold, z, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg FROM x GROUP BY 1, 2, 3),
        c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER t AS pp, sum(neg) OVER t AS nn FROM n WINDOW w AS (PARTITION BY weight, fold ORDER BY z DESC), t AS (PARTITION BY weight, fold))
        SELECT weight, fold, round(sum(pos * (nn - fp + neg / 2)) / (max(pp) * max(nn)), 8) AS roc_auc, round(sum(pos * tp / (tp + fp)) / max(pp), 8) AS average_precision FROM c GROUP BY 1, 2""",
)
def blend_sweep(t):
    blended = V.blend(scored(t), "p", "b")
    out = V.auc_ap(V.score_curve(blended, "blended", "y", ["weight", "fold"]), ["weight", "fold"])
    return out.select("weight", "fold", R("roc_auc", 8).alias("roc_auc"), R("average_precision", 8).alias("average_precision"))


def at_sql(name, cut):
    return f"""SELECT '{name}' AS strategy, round({cut}, 6) AS threshold, round((tp + tn) / (tp + fp + tn + fn), 8) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 8) AS "precision", round(tp / (tp + fn), 8) AS recall,
      round(2 * tp / (2 * tp + fp + fn), 8) AS f1 FROM (SELECT count(*) FILTER (y = 1 AND p >= {cut}) AS tp, count(*) FILTER (y = 0 AND p >= {cut}) AS fp, count(*) FILTER (y = 0 AND p < {cut}) AS tn, count(*) FILTER (y = 1 AND p < {cut}) AS fn FROM s)"""


@query(
    "evl25",
    f"WITH {SCORED}, {CURVE}, best AS (SELECT threshold FROM f ORDER BY f1 DESC, threshold DESC LIMIT 1) {at_sql('default', '0.5::DOUBLE')} UNION ALL {at_sql('chosen', '(SELECT threshold FROM best)')}",
)
def holdout_report(t):
    df = scored(t)
    cut = V.best_threshold(V.score_curve(df, "p", "y")).select("threshold").scalar()
    strategies = F.array(F.struct(F.lit("default").alias("name"), F.lit(0.5).alias("cut")), F.struct(F.lit("chosen").alias("name"), F.col("_best").alias("cut")))
    rows = df.withColumn("_best", cut).select("y", "p", F.inline(strategies).alias("strategy", "threshold"))
    m = V.class_metrics(V.counts_at(rows, "y", (F.col("p") >= F.col("threshold")).cast("int"), ["strategy", "threshold"]))
    return m.select("strategy", R("threshold", 6).alias("threshold"), *[R(c, 8).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query(
    "evl27",
    """WITH r AS (SELECT o_orderpriority AS model, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS roc_auc, avg(CASE WHEN o_orderstatus = 'O' THEN 1.0 ELSE 0.0 END) AS average_precision FROM orders GROUP BY 1)
       SELECT (SELECT model FROM r ORDER BY roc_auc DESC, average_precision DESC, model LIMIT 1) AS best_model, (SELECT max(roc_auc) FROM r) - (SELECT roc_auc FROM r WHERE model = '5-LOW') >= 0.002 AS tune_challenger,
       (SELECT max(roc_auc) FROM r) > 0.33 AS train_final""",
)
def choice_gates(t):
    r = t.orders.groupBy(F.col("o_orderpriority").alias("model")).agg(
        F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("roc_auc"),
        F.avg(F.when(F.col("o_orderstatus") == "O", 1.0).otherwise(0.0)).alias("average_precision"),
    )
    pinned = F.max(F.when(F.col("model") == "5-LOW", F.col("roc_auc")))
    return r.agg(
        F.max_by("model", F.struct("roc_auc", "average_precision")).alias("best_model"),
        (F.max("roc_auc") - pinned >= 0.002).alias("tune_challenger"),
        (F.max("roc_auc") > 0.33).alias("train_final"),
    )
