"""Fitted cleaning steps: imputation, scaling, level maps. Everything is learned from the training rows only.

What is learned is a few numbers per column, so a fitted step is a set of column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .aggregate import most_frequent
from .quantiles import exact_quantiles


def long_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, value) rows of several numeric columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(pairs))


def medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact, interpolated medians of several columns; one number per column reaches the driver."""
    found = exact_quantiles(long_numbers(df, columns), "value", {"m": 0.5}, ["name"]).collect()
    return {r.name: r.m for r in found}


def modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The most frequent non-null value of several columns, the smallest on a tie."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    best = most_frequent(df.select(F.inline(pairs)), ["name"], "value", "mode").collect()
    return {r.name: r.mode for r in best}


@dataclass
class Filler:
    """Null replacement by learned values, with optional 0/1 columns that say what was missing."""

    values: dict
    flags: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        if self.flags:
            df = df.withColumns({f"{c}_MISSING": F.col(c).isNull().cast("int") for c in self.values})
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.values.items()})


@dataclass
class Scaler:
    """Mean 0 and population standard deviation 1; a constant column becomes 0."""

    moments: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - m) / F.lit(s if s else 1.0) for c, (m, s) in self.moments.items()})


def fit_scaler(df: DataFrame, columns: list[str]) -> Scaler:
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).head()
    return Scaler({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns})


def level_map(df: DataFrame, column: str, min_frequency: int = 1, max_levels: int | None = None) -> DataFrame:
    """(level, n, grouped): which levels keep a column of their own and which become "infrequent".

    With ``max_levels``, at most that many output levels exist, the group of rare ones included.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.filter(F.col("n") >= min_frequency)
    if max_levels is not None:
        n_all, n_frequent = counts.agg(F.count("*")).scalar(), frequent.agg(F.count("*")).scalar()
        # One place goes to the group of rare levels when something has to be grouped.
        room = F.when((n_all <= max_levels) & (n_frequent == n_all), F.lit(max_levels)).otherwise(F.lit(max_levels - 1))
        top = frequent.orderBy(F.desc("n"), "level").limit(max_levels)
        placed = top.withColumn("_rn", F.row_number().over(W.orderBy(F.desc("n"), "level"))).withColumn("_room", room)
        frequent = placed.filter(F.col("_rn") <= F.col("_room")).select("level", "n")
    kept = frequent.select(F.col("level").alias("_kept"))
    marked = counts.join(kept, F.col("level") == F.col("_kept"), "left")
    return marked.select("level", "n", F.when(F.col("_kept").isNotNull(), F.col("level")).otherwise("infrequent").alias("grouped"))


@dataclass
class OneHot:
    """0/1 columns per kept level; rare levels share one column, unknown ones get all zeros."""

    column: str
    kept: list[str]
    rare: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        x = F.col(self.column).cast("string")
        out = {f"{self.column}_{v}": F.coalesce(x == v, F.lit(False)).cast("int") for v in self.kept}
        if self.rare:
            out[f"{self.column}_infrequent"] = F.coalesce(x.isin(self.rare), F.lit(False)).cast("int")
        return df.withColumns(out).drop(self.column)


def fit_one_hot(df: DataFrame, column: str, min_frequency: int = 1, max_levels: int | None = None) -> OneHot:
    """The levels that become columns; the list is as long as the schema of the result."""
    rows = level_map(df, column, min_frequency, max_levels).collect()
    kept = sorted(r.level for r in rows if r.grouped != "infrequent")
    return OneHot(column, kept, sorted(r.level for r in rows if r.grouped == "infrequent"))


def anova_f(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """(name, f): between-class over within-class variance of every column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.col(label).alias("_y"), F.inline(pairs))
    per = long.groupBy("name", "_y").agg(F.count("value").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    total = per.groupBy("name").agg(
        F.sum("n").alias("all"), F.count("*").alias("k"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean")
    )
    both = per.join(total, "name").groupBy("name", "all", "k").agg(
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("mean"), 2)).alias("between"), F.sum(F.col("n") * F.col("v")).alias("within")
    )
    f = (F.col("between") / (F.col("k") - 1)) / F.nullif(F.col("within") / (F.col("all") - F.col("k")), F.lit(0))
    return both.select("name", f.alias("f"))
