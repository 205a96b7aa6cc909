"""Column profiles of whole tables, issue flags and output checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import safe_divide
from .stats import sample_skewness


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: counts, missing, distinct, share of the commonest value, moments of the numbers.

    The moments of all columns come from one aggregate. Exact distinct counts and the commonest
    value come from counts per (column, value); with ``approximate`` the distinct counts are
    sketches in the same single pass and the commonest value is left out.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    null = F.lit(None).cast("double")
    parts = []
    for f in df.schema.fields:
        c, is_number = F.col(f"`{f.name}`"), f.name in numeric
        x = c.cast("double")
        fields = [
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(c.isNull()).alias("n_missing"),
            (F.approx_count_distinct(c) if approximate else F.lit(None).cast("bigint")).alias("n_distinct"),
            (F.min(x) if is_number else null).alias("min"),
            (F.max(x) if is_number else null).alias("max"),
            (F.avg(x) if is_number else null).alias("mean"),
            (F.stddev_samp(x) if is_number else null).alias("std"),
            (sample_skewness(x) if is_number else null).alias("skewness"),
            (F.avg((x == 0).cast("int")) if is_number else null).alias("p_zeros"),
        ]
        parts.append(F.struct(*fields))
    wide = df.agg(F.array(*parts).alias("p")).select(F.inline("p"))
    if approximate:
        out = wide.withColumn("top_share", null)
    else:
        shares = distinct_values(df)
        out = wide.drop("n_distinct").join(shares, "column_name")
        out = out.withColumn("top_share", safe_divide(F.col("top"), F.col("n"))).drop("top")
    present = F.col("n") - F.col("n_missing")
    return out.select(
        "column_name",
        "type",
        "n",
        "n_missing",
        safe_divide(F.col("n_missing"), F.col("n")).alias("p_missing"),
        "n_distinct",
        safe_divide(F.col("n_distinct"), F.col("n")).alias("p_distinct"),
        (F.col("n_distinct") == present).alias("is_unique"),
        "min",
        "max",
        "mean",
        "std",
        "skewness",
        "p_zeros",
        "top_share",
    )


def distinct_values(df: DataFrame) -> DataFrame:
    """(column_name, n_distinct, top): distinct non-null values and rows of the commonest value, null included."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in df.columns])
    counts = df.select(F.inline(pairs)).groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("k"))
    return counts.groupBy("column_name").agg(F.count("v").alias("n_distinct"), F.max("k").alias("top"))


def top_columns(profiles: DataFrame, table: str, by: str, k: int = 8) -> DataFrame:
    """The k columns of every table with the largest ``by``. A profile has one row per column."""
    w = W.partitionBy(table).orderBy(F.desc(by), "column_name")
    return profiles.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


# Limits of the issue flags.
HIGH_MISSING, SOME_MISSING, NEAR_CONSTANT, UNIQUE_LIKE, EXTREME_SKEW = 0.50, 0.25, 0.995, 0.995, 10.0


def with_issues(profiles: DataFrame, sentinels: dict[str, str] | None = None) -> DataFrame:
    """Adds ``issue_count`` and ``issues`` (text) to a profile."""
    known = list(sentinels or {})
    flags = [
        F.when(F.col("p_missing") >= HIGH_MISSING, "high missing").when(F.col("p_missing") >= SOME_MISSING, "moderate missing"),
        F.when(F.col("top_share") >= NEAR_CONSTANT, "near constant"),
        F.when(F.col("is_unique") | (F.col("p_distinct") >= UNIQUE_LIKE), "unique id like"),
        F.when(F.abs("skewness") >= EXTREME_SKEW, "extreme skew"),
        F.when(F.col("column_name").isin(known) if known else F.lit(False), "known sentinel"),
    ]
    found = F.array_compact(F.array(*flags))
    return profiles.withColumns({"issue_count": F.size(found), "issues": F.concat_ws("; ", found)})


def output_checks(scores: DataFrame, expected: DataFrame, key: str, score: str, columns: list[str]) -> DataFrame:
    """One row of counts that must all be zero for a table of scores to be accepted."""
    bad = scores.agg(
        F.count_if(~F.coalesce(F.col(score).between(0, 1), F.lit(False))).alias("outside_range"),
        F.abs(F.count(F.lit(1)) - expected.agg(F.count(F.lit(1))).scalar()).alias("row_difference"),
        F.lit(0 if list(scores.columns) == columns else 1).cast("bigint").alias("wrong_columns"),
    )
    ids = expected.select(key).join(scores.select(key), key, "left_anti").agg(F.count(F.lit(1))).scalar()
    extra = scores.select(key).join(expected.select(key), key, "left_anti").agg(F.count(F.lit(1))).scalar()
    return bad.select("*", ids.alias("missing_ids"), extra.alias("unknown_ids"))


def accept(checks: DataFrame) -> None:
    """Raise when a check found something."""
    row = checks.head().asDict()
    bad = {k: v for k, v in row.items() if v}
    if bad:
        raise ValueError(f"output refused: {bad}")


def class_balance(df: DataFrame, split: str, target: str) -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("positive_rate"))
