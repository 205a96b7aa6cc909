"""Target encodings: the mean target of a category, with a minimum count, never from a row's own fold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import durable
from .ordered import Ordered, ordered, stable_hash

KEY = "SK_ID_CURR"
MIN_COUNT = 50


def fit_encoding(df: DataFrame, column: str, target: str, min_count: int = MIN_COUNT) -> DataFrame:
    """(column, te): the mean target of every non-null category with enough rows."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.avg(target).alias("te"), F.count(target).alias("n"))
        .filter(F.col("n") >= min_count)
        .select(column, "te")
    )


def apply_encoding(df: DataFrame, column: str, encoding: DataFrame, default, name: str) -> DataFrame:
    """Unseen, rare and null categories get ``default`` (a column or a scalar subquery)."""
    # one row per category, written: the planner knows its size and moves the rows only if it is large
    hit = durable(encoding.select(F.col(column).alias("_cat"), F.col("te").alias("_te")))
    joined = df.join(hit, F.col(column) == F.col("_cat"), "left").withColumn("_default", default)
    return joined.withColumn(name, F.coalesce("_te", "_default")).drop("_cat", "_te", "_default")


def global_mean(df: DataFrame, target: str):
    return df.agg(F.avg(target)).scalar()


def child_summary(encoded: DataFrame, prefix: str, key: str = KEY) -> DataFrame:
    return encoded.groupBy(key).agg(
        F.avg("_encoded").alias(f"{prefix}_MEAN"), F.max("_encoded").alias(f"{prefix}_MAX"), F.count(F.lit(1)).alias(f"{prefix}_COUNT")
    )


def child_encoding(child: DataFrame, column: str, fit: DataFrame, apply_to: DataFrame, target: str = "TARGET", min_count: int = MIN_COUNT) -> DataFrame:
    """Encode the child rows of ``apply_to`` by the targets of ``fit``; mean, max and count per applicant."""
    prefix = f"TE_PREV_{column}"
    rows = child.select(KEY, column)
    fitted = rows.join(fit.select(KEY, target), KEY)
    mean = global_mean(fitted, target)
    encoded = apply_encoding(
        rows.join(apply_to.select(KEY), KEY, "left_semi"), column, fit_encoding(fitted, column, target, min_count), mean, "_encoded"
    )
    out = apply_to.select(KEY).join(child_summary(encoded, prefix), KEY, "left").withColumn("_mean", mean)
    return out.select(
        KEY,
        F.coalesce(f"{prefix}_MEAN", "_mean").alias(f"{prefix}_MEAN"),
        F.coalesce(f"{prefix}_MAX", "_mean").alias(f"{prefix}_MAX"),
        F.coalesce(f"{prefix}_COUNT", F.lit(0)).alias(f"{prefix}_COUNT"),
    )


def out_of_fold(df: DataFrame, column: str, target: str, fold: str, name: str, min_count: int = MIN_COUNT) -> DataFrame:
    """Encode every row by the rows of the other folds, without a loop over folds.

    Sums per (category, fold) are enough: what the other folds say is the total less the own part.
    """
    parts = durable(df.filter(F.col(column).isNotNull()).groupBy(column, fold).agg(F.sum(target).alias("_s"), F.count(target).alias("_n")))
    totals = parts.groupBy(column).agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    others_s, others_n = F.col("_ts") - F.col("_s"), F.col("_tn") - F.col("_n")
    encoding = durable(
        parts.join(totals, column).select(
            F.col(column).alias("_cat"), F.col(fold).alias("_fold"), F.when(others_n >= min_count, others_s / others_n).alias("_te")
        )
    )
    whole = durable(df.groupBy(fold).agg(F.sum(target).alias("_s"), F.count(target).alias("_n")))
    everything = whole.agg(F.struct(F.sum("_s").alias("s"), F.sum("_n").alias("n")).alias("a")).scalar()
    rest = whole.withColumn("_a", everything).select(
        F.col(fold).alias("_wfold"), ((F.col("_a.s") - F.col("_s")) / F.nullif(F.col("_a.n") - F.col("_n"), F.lit(0))).alias("_rest")
    )
    joined = df.join(encoding, (F.col(column) == F.col("_cat")) & (F.col(fold) == F.col("_fold")), "left").join(
        rest, F.col(fold) == F.col("_wfold"), "left"
    )
    return joined.withColumn(name, F.coalesce("_te", "_rest")).drop("_cat", "_fold", "_te", "_wfold", "_rest")


def child_out_of_fold(child: DataFrame, column: str, base: DataFrame, target: str = "TARGET", fold: str = "fold", min_count: int = MIN_COUNT) -> DataFrame:
    """Out-of-fold encoding of child rows, summarised per applicant; applicants without child rows get the mean, the mean and 0."""
    prefix = f"TE_PREV_{column}"
    rows = durable(child.select(KEY, column).join(base.select(KEY, target, fold), KEY))
    encoded = out_of_fold(rows, column, target, fold, "_encoded", min_count)
    whole = rows.groupBy(fold).agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    everything = whole.agg(F.struct(F.sum("_s").alias("s"), F.sum("_n").alias("n")).alias("a")).scalar()
    rest = whole.withColumn("_a", everything).select(fold, ((F.col("_a.s") - F.col("_s")) / F.nullif(F.col("_a.n") - F.col("_n"), F.lit(0))).alias("_mean"))
    out = base.select(KEY, fold).join(child_summary(encoded, prefix), KEY, "left").join(rest, fold, "left")
    return out.select(
        KEY,
        F.coalesce(f"{prefix}_MEAN", "_mean").alias(f"{prefix}_MEAN"),
        F.coalesce(f"{prefix}_MAX", "_mean").alias(f"{prefix}_MAX"),
        F.coalesce(f"{prefix}_COUNT", F.lit(0)).alias(f"{prefix}_COUNT"),
    )


def _levels(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """(keep, _column, _level): one row per row and categorical column; null is a level of its own."""
    cells = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_level")) for c in columns])
    return df.select(*keep, F.inline(cells))


def _spread_back(df: DataFrame, placed: DataFrame, columns: list[str], key: str, value, suffix: str) -> DataFrame:
    """``value`` of every (row, column) as one column per categorical column beside the rows of ``df``."""
    wide = placed.groupBy(key).agg(*[F.max(F.when(F.col("_column") == c, value)).alias(f"{c}{suffix}") for c in columns])
    return df.join(wide.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key")).drop("_key")


def ordered_statistics(
    df: DataFrame, columns: list[str], target: str, key: str, order=None, prior: float = 0.5, strength: float = 1.0, suffix: str = "_ts"
) -> DataFrame:
    """Adds one column per categorical column: the mean target of the rows with the same level that come before in a random order.

    ``(sum before + strength * prior) / (rows before + strength)``: prefix sums per (column, level), so a row is never
    encoded by its own target or a later one, and any number of levels is as good as two. The order is a hash of the (unique)
    key unless a column ``order`` is given. Running sums go over ranges of the order, so a hot level is not one task.
    """
    rows = _levels(df.withColumn("_o", stable_hash(key, seed=17) if order is None else order), columns, key, "_o", target)
    spec = Ordered(order="_o", keys=["_column", "_level"], tie=[key], running={"_s": ("sum", target), "_n": ("count", target)})
    placed = ordered(rows, spec)
    own, counted = F.coalesce(F.col(target), F.lit(0)), F.col(target).isNotNull().cast("int")
    value = (F.coalesce(F.col("_s"), F.lit(0)) - own + strength * prior) / (F.col("_n") - counted + strength)
    return _spread_back(df, placed, columns, key, value, suffix)


def target_statistics(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """(_column, _level, _s, _n): sums and counts of the target over all rows of each level, written."""
    return durable(_levels(df, columns, target).groupBy("_column", "_level").agg(F.sum(target).alias("_s"), F.count(target).alias("_n")))


def apply_statistics(df: DataFrame, columns: list[str], key: str, table: DataFrame, prior: float = 0.5, strength: float = 1.0, suffix: str = "_ts") -> DataFrame:
    """The columns of ``ordered_statistics`` for rows that are not learned from: all learned rows count, an unseen level gets the prior."""
    rows = _levels(df, columns, key)
    known = table.select(F.struct("_column", "_level").alias("_k"), "_s", "_n")  # a struct equals itself with a null level too
    placed = rows.withColumn("_v", F.struct("_column", "_level")).join(known, F.col("_v") == F.col("_k"), "left")
    value = (F.coalesce(F.col("_s"), F.lit(0)) + strength * prior) / (F.coalesce(F.col("_n"), F.lit(0)) + strength)
    return _spread_back(df, placed, columns, key, value, suffix)
