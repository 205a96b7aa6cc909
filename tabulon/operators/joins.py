"""Joins where a key may be hot on both sides, and the check that tells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multiplicity(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: the largest number of rows per key on each side and the rows an inner join would give."""
    a = left.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("a"))
    b = right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("b"))
    both = a.join(b, key, "full")
    return both.agg(
        F.max("a").alias("left_max"),
        F.max("b").alias("right_max"),
        F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias("joined_rows"),
    ).withColumn(
        "kind",
        F.concat(
            F.when(F.col("left_max") > 1, "N").otherwise("1"), F.lit(":"), F.when(F.col("right_max") > 1, "N").otherwise("1")
        ),
    )


def hot_keys(df: DataFrame, key: str, pieces: int) -> DataFrame:
    """(_hot): the keys that hold more than ``1 / pieces`` of the rows; fewer than ``pieces`` rows by definition."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    return counts.filter(F.col("c") * pieces > counts.agg(F.sum("c")).scalar()).select(F.col(key).alias("_hot"))


def pieces_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def salted(df: DataFrame, key: str, hot: DataFrame, pieces: int) -> DataFrame:
    """Adds ``_salt``: 0, or for a hot key a hash of the row. A task that runs again gives the same rows."""
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*df.columns), F.lit(pieces)).cast("int")).otherwise(0)
    return df.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt).drop("_hot")


def gathered(df: DataFrame, key: str) -> DataFrame:
    """The rows of a key brought into one task, those of a hot key into several.

    For aggregates with so many outputs that a row of partial results is wider than the rows it
    stands for: shuffling the rows themselves once is cheaper than shuffling partial results.
    """
    n = pieces_of(df)
    return salted(df, key, hot_keys(df.select(key), key, n), n).repartition(key, "_salt")


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner", pieces: int | None = None) -> DataFrame:
    """Equi join on one key (inner or left) whose left rows may pile up on a few keys.

    Hot keys are found first. Their left rows are spread over ``pieces`` salts and their right rows
    repeated once per salt; all other keys join as usual.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left")
    n = pieces or pieces_of(left)
    hot = hot_keys(left.select(key), key, n)
    copies = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted(left, key, hot, n).join(repeated, [key, "_salt"], how).drop("_salt")
