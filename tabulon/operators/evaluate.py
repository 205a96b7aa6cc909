"""Evaluation of binary scores from one table per distinct score, without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import safe_divide
from .ordered import Ordered, cut_points, ordered


def zero_divide(a, b) -> Column:
    """``a / b``, 0 when the divisor is 0."""
    return F.coalesce(safe_divide(a, b), F.lit(0.0))


def score_curve(df: DataFrame, score: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """Per key and distinct score: rows (pos, neg) and, from the highest score down, running tp and fp, totals p and n."""
    keys = list(keys or [])
    y = F.col(label)
    rows = df.select(*keys, F.col(score).alias("threshold"), (-F.col(score)).alias("_down"), y.alias("_y"))
    groups = rows.groupBy(*keys, "threshold", "_down").agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
    spec = Ordered(
        order="_down",
        keys=keys,
        running={"tp": ("sum", "pos"), "fp": ("sum", "neg")},
        total={"p": ("sum", "pos"), "n": ("sum", "neg")},
    )
    return ordered(groups, spec, cut_points(rows, "_down")).drop("_down")


def auc_ap(curve: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """ROC-AUC with ties counted half, and average precision in its step form."""
    below = F.col("n") - F.col("fp") + F.col("neg") / 2
    auc = safe_divide(F.sum(F.col("pos") * below), F.max("p") * F.max("n"))
    precision = zero_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    ap = safe_divide(F.sum(F.col("pos") * precision), F.max("p"))
    return curve.groupBy(*(keys or [])).agg(auc.alias("roc_auc"), ap.alias("average_precision"))


def rates(curve: DataFrame) -> DataFrame:
    """The curve with precision, recall, F1 and the false positive rate at every threshold."""
    precision = zero_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = zero_divide(F.col("tp"), F.col("p"))
    return curve.withColumns({"precision": precision, "recall": recall, "fpr": zero_divide(F.col("fp"), F.col("n"))}).withColumn(
        "f1", zero_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    )


def best_threshold(curve: DataFrame, min_precision: float | None = None) -> DataFrame:
    """The threshold with the highest F1; with a floor, the highest recall that keeps the precision.

    When no threshold reaches the floor, the F1 rule decides. The highest threshold wins a tie.
    """
    points = rates(curve)
    by_f1 = F.struct(F.lit(0).alias("r"), F.lit(0.0).alias("a"), F.col("f1").alias("b"), F.col("threshold").alias("c"))
    rank = by_f1
    if min_precision is not None:
        by_recall = F.struct(F.lit(1).alias("r"), F.col("recall").alias("a"), F.col("f1").alias("b"), F.col("threshold").alias("c"))
        rank = F.when(F.col("precision") >= min_precision, by_recall).otherwise(by_f1)
    chosen = F.max_by(F.struct("threshold", "precision", "recall", "f1"), rank)
    return points.agg(chosen.alias("s")).select("s.*")


def predicted(score: str, threshold) -> Column:
    return (F.col(score) >= threshold).cast("int")


def confusion(df: DataFrame, label: str, pred: Column) -> DataFrame:
    """The 2 x 2 table, zero cells included."""
    grid = [(a, b) for a in (0, 1) for b in (0, 1)]
    y = F.col(label)
    counts = df.select(y.alias("y"), pred.alias("q")).agg(
        *[F.count_if((F.col("y") == a) & (F.col("q") == b)).alias(f"c{a}{b}") for a, b in grid]
    )
    cells = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("n")) for a, b in grid])
    return counts.select(F.inline(cells))


def counts_at(df: DataFrame, label: str, pred: Column, keys: list[str] | None = None) -> DataFrame:
    y = F.col(label)
    return df.withColumn("_q", pred).groupBy(*(keys or [])).agg(
        F.count_if((y == 1) & (F.col("_q") == 1)).alias("tp"),
        F.count_if((y == 0) & (F.col("_q") == 1)).alias("fp"),
        F.count_if((y == 0) & (F.col("_q") == 0)).alias("tn"),
        F.count_if((y == 1) & (F.col("_q") == 0)).alias("fn"),
    )


def class_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class from the four counts."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    out = counts.withColumns(
        {
            "accuracy": zero_divide(tp + tn, tp + fp + tn + fn),
            "precision": zero_divide(tp, tp + fp),
            "recall": zero_divide(tp, tp + fn),
        }
    )
    return out.withColumn("f1", zero_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def report(df: DataFrame, label: str, pred: Column) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means."""
    c = counts_at(df, label, pred)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))

    def row(name, hit, wrong, missed):
        p, r = zero_divide(hit, hit + wrong), zero_divide(hit, hit + missed)
        return F.struct(
            F.lit(name).alias("label"),
            p.alias("precision"),
            r.alias("recall"),
            zero_divide(2 * p * r, p + r).alias("f1"),
            (hit + missed).alias("support"),
        )

    wide = c.withColumns({"a": row("0", tn, fn, fp), "b": row("1", tp, fp, fn)})
    total = tp + fp + tn + fn
    share = zero_divide(tp + tn, total)

    def mean(name, wa, wb):
        part = lambda f: wa * F.col(f"a.{f}") + wb * F.col(f"b.{f}")
        return F.struct(
            F.lit(name).alias("label"), part("precision").alias("precision"), part("recall").alias("recall"), part("f1").alias("f1"), total.alias("support")
        )

    half = F.lit(0.5)
    wa, wb = zero_divide(F.col("a.support"), total), zero_divide(F.col("b.support"), total)
    accuracy = F.struct(F.lit("accuracy").alias("label"), share.alias("precision"), share.alias("recall"), share.alias("f1"), total.alias("support"))
    rows = F.array(F.col("a"), F.col("b"), accuracy, mean("macro avg", half, half), mean("weighted avg", wa, wb))
    return wide.select(F.inline(rows))


def cost_curve(curve: DataFrame, miss: float = 100.0, false_alarm: float = 10.0) -> DataFrame:
    cost = miss * (F.col("p") - F.col("tp")) + false_alarm * F.col("fp")
    return curve.select("threshold", cost.alias("cost"))


def calibration(df: DataFrame, score: str, label: str, bins: int) -> DataFrame:
    """Mean score and positive rate per equal-width bin of [0, 1]; empty bins are left out."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).alias("bin")
    return df.groupBy(place).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(label).alias("positive_rate"))


def brier_and_log_loss(df: DataFrame, score: str, label: str, clip: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(score), F.lit(clip)), F.lit(1 - clip))
    y = F.col(label)
    loss = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return df.agg(F.avg(F.pow(F.col(score) - y, 2)).alias("brier"), F.avg(loss).alias("log_loss"))


def regression_metrics(df: DataFrame, actual: str, guess: str) -> DataFrame:
    e = F.col(actual) - F.col(guess)
    n = F.count(actual)
    return df.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - safe_divide(F.sum(e * e), F.var_pop(actual) * n)).alias("r2"),
    )


def blend(df: DataFrame, a: str, b: str, weights=(0.5, 0.6, 0.7, 0.8)) -> DataFrame:
    """One row per input row and weight with ``blended = w * a + (1 - w) * b``."""
    w = F.explode(F.array(*[F.lit(x) for x in weights]))
    return df.withColumn("weight", w).withColumn("blended", F.col("weight") * F.col(a) + (1 - F.col("weight")) * F.col(b))


def importance_table(gain: DataFrame, source: str, value: str) -> DataFrame:
    """Total, largest and positive importance per source column, and the share of the total."""
    x = F.col(value)
    per = gain.groupBy(F.col(source).alias("source_column")).agg(
        F.sum(x).alias("total_gain"),
        F.max(x).alias("max_gain"),
        F.count(x).alias("feature_count"),
        F.count_if(x > 0).alias("positive_count"),
    )
    return per.withColumn("gain_share", safe_divide(F.col("total_gain"), per.agg(F.sum("total_gain")).scalar()))


def coefficient_table(coefs: DataFrame, name: str, value: str, k: int = 25, limit: float = 20.0) -> DataFrame:
    """The k largest coefficients by size, with direction and odds multiplier."""
    c = F.col(value)
    clipped = F.least(F.greatest(c, F.lit(-limit)), F.lit(limit))
    out = coefs.select(
        name,
        c.alias("coefficient"),
        F.abs(c).alias("size"),
        F.when(c > 0, "increases").when(c < 0, "decreases").otherwise("none").alias("direction"),
        F.exp(clipped).alias("odds_multiplier"),
    )
    return out.orderBy(F.desc("size"), name).limit(k)


def combine_importances(a: DataFrame, b: DataFrame, key: str, a_value: str, b_value: str) -> DataFrame:
    """Outer join of two importance tables, 0 where absent, with a rank for each (ties share the lowest).

    The tables hold one row per model input, so the ranks are plain windows.
    """
    both = a.join(b, key, "full").fillna(0.0, [a_value, b_value])
    down = lambda c: F.rank().over(W.orderBy(F.desc(c)))
    return both.withColumns({f"{a_value}_rank": down(a_value), f"{b_value}_rank": down(b_value)})
