"""Stratified splits and folds by a hash order: exact shares, the same rows under any partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import Ordered, ordered, stable_hash


def _placed(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    shuffled = df.withColumn("_h", stable_hash(key, seed=seed))
    spec = Ordered(order="_h", keys=[label], tie=[key], row_number="_rn", total={"_class": ("count", "_h")})
    return ordered(shuffled, spec).drop("_h")


def stratified_split(df: DataFrame, key: str, label: str, test: float = 0.2, valid: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``split``: ``test`` of every class, then ``valid`` of the rest, else train."""
    n_test = F.round(F.col("_class") * test)
    n_valid = F.round((F.col("_class") - n_test) * valid)
    split = F.when(F.col("_rn") <= n_test, "test").when(F.col("_rn") <= n_test + n_valid, "valid").otherwise("train")
    return _placed(df, key, label, seed).withColumn("split", split).drop("_rn", "_class")


def stratified_folds(df: DataFrame, key: str, label: str, k: int, seed: int = 42, name: str = "fold") -> DataFrame:
    """Adds a fold number 0 to k - 1; every class is dealt out in turn."""
    return _placed(df, key, label, seed).withColumn(name, ((F.col("_rn") - 1) % k).cast("int")).drop("_rn", "_class")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight, positive_weight): n / (2 n_c) per class, and negatives per positive."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    t = c.agg(
        F.struct(
            F.sum("n").alias("all"),
            F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("pos"),
            F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("neg"),
        )
    ).scalar()
    return c.withColumn("_t", t).select(
        label, (F.col("_t.all") / (2 * F.col("n"))).alias("weight"), (F.col("_t.neg") / F.col("_t.pos")).alias("positive_weight")
    )
