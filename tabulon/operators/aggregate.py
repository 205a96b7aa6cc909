"""Generated aggregates: one ``groupBy`` per table however many columns are wanted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import present
from .joins import gathered

WIDE = 60  # outputs beyond which partial results outweigh the rows they stand for


# One statistic as SQL, with the null rules of a data frame library: an all-null sum is 0. Wide tables
# have hundreds of these, and a parsed text is much quicker to hand over than a tree of calls.
STATS = {
    "mean": "avg({x})",
    "max": "max({x})",
    "min": "min({x})",
    "sum": "coalesce(sum({x}), 0D)",
    "count": "count({x})",
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def numeric_stats(columns: list[str], prefix: str, stats=("mean", "max", "min", "sum")) -> list[Column]:
    """Every statistic of every column, named PREFIX_COLUMN_STAT."""
    return [
        F.expr(f"{STATS[s].format(x=f'CAST({quoted(c)} AS DOUBLE)')} AS {quoted(f'{prefix}_{c}_{s}'.upper())}")
        for c in columns
        for s in stats
    ]


def levels(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """The non-null values of columns that are to become columns, sorted; one pass for all of them.

    The caller asks for one output column per value, so the list is as long as the schema of its result.
    ``level_profile`` has the same numbers as rows, for any number of values.
    """
    columns = present(df, columns)
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])
    found = df.select(F.inline(pairs)).filter("v is not null").distinct().collect()
    return {c: sorted(r.v for r in found if r.c == c) for c in columns}


def level_profile(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column_name, level, n, rate): rows per value of every column and key, null as a value of its own; no limit on values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level")) for c in present(df, columns)])
    counts = df.filter(F.col(key).isNotNull()).select(key, F.inline(pairs)).groupBy(key, "column_name", "level").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(key, "column_name").agg(F.sum("n").alias("_all"))
    return counts.join(total, [key, "column_name"]).select(key, "column_name", "level", "n", (F.col("n") / F.col("_all")).alias("rate"))


def sparse_profile(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column_name, counts, n_null, n_rows): per key and column a map of its own values to their numbers of rows.

    Rows are counted per (key, column, value) before anything is brought together, so a key's map is as long as its own distinct values;
    no list of all values exists anywhere. ``named_levels`` makes columns of the values that a caller names.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("level")) for c in present(df, columns)])
    counts = df.filter(F.col(key).isNotNull()).select(key, F.inline(pairs)).groupBy(key, "column_name", "level").agg(F.count(F.lit(1)).alias("n"))
    entry = F.when(F.col("level").isNotNull(), F.struct("level", "n"))
    return counts.groupBy(key, "column_name").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("counts"),
        F.coalesce(F.sum(F.when(F.col("level").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.sum("n").alias("n_rows"),
    )


def named_levels(sparse: DataFrame, key: str, columns: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """One row per key: counts and rates of the named values of each column, null as a value of its own, as ``level_counts`` names them.

    ``columns`` maps a column to the prefix of its outputs and its values.
    """
    outs = []
    for column, (prefix, values) in columns.items():
        here = F.col("column_name") == column
        numbers = [F.coalesce(F.col("counts")[v], F.lit(0)) for v in values] + [F.col("n_null")]
        for name, n in zip(level_names(prefix, values), numbers):
            outs.append(F.max(F.when(here, n)).alias(name))
            outs.append(F.max(F.when(here, n / F.col("n_rows"))).alias(f"{name}_RATE"))
    return sparse.groupBy(key).agg(*outs)


def level_counts(column: str, prefix: str, values: list) -> list[Column]:
    """Rows per value, null as a value of its own, named PREFIX_VALUE."""
    x = f"CAST({quoted(column)} AS STRING)"
    tests = [f"{x} = {text(v)}" for v in values] + [f"{quoted(column)} IS NULL"]
    return [F.expr(f"count_if({t}) AS {quoted(n)}") for t, n in zip(tests, level_names(prefix, values))]


def level_names(prefix: str, values: list) -> list[str]:
    return [f"{prefix}_{v}".upper() for v in [*values, "nan"]]


def level_rates(prefix: str, values: list) -> list[Column]:
    """Share of each value in its group, from the columns of ``level_counts``."""
    names = level_names(prefix, values)
    total = f"nullif({' + '.join(quoted(n) for n in names)}, 0)"
    return [F.expr(f"{quoted(n)} / {total} AS {quoted(f'{n}_RATE')}") for n in names]


def key_profile(
    df: DataFrame,
    key: str,
    prefix: str,
    numerics: list[str],
    categories: dict[str, str] | None = None,
    stats=("mean", "max", "min", "sum"),
    record_count: str | None = None,
    extra: list[Column] | None = None,
) -> tuple[DataFrame, dict[str, list]]:
    """One row per key: statistics of the numbers, counts and rates of the categories.

    ``categories`` maps a column to the prefix of its outputs. Missing columns are left out.
    """
    numerics = present(df, numerics)
    found = levels(df, list(categories or {}))
    aggs = [F.count(F.lit(1)).alias(record_count)] if record_count else []
    aggs += numeric_stats(numerics, prefix, stats)
    for column, values in found.items():
        aggs += level_counts(column, categories[column], values)
    aggs += extra or []
    rows = df.filter(F.col(key).isNotNull())
    if len(aggs) > WIDE:
        rows = gathered(rows, key)
    wide = rows.groupBy(key).agg(*aggs)
    rates = [r for column, values in found.items() for r in level_rates(categories[column], values)]
    return wide.select("*", *rates), found


def within(cond: Column, kind: str, x: Column | None = None) -> Column:
    """Aggregate over the rows that meet a test; null for a key without such a row."""
    rows = F.count_if(cond)
    if kind == "count":
        return F.nullif(rows, F.lit(0))
    picked = F.when(cond, x)
    if kind == "sum":
        return F.when(rows > 0, F.coalesce(F.sum(picked), F.lit(0)))
    return {"mean": F.avg, "max": F.max, "min": F.min}[kind](picked)


def most_frequent(df: DataFrame, key: list[str], column: str, name: str) -> DataFrame:
    """The most frequent non-null value per key, the smallest on a tie."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*key, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*key).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(name))


def most_recent(column: str, order: Column) -> Column:
    """The non-null value with the largest order."""
    return F.max_by(F.col(column), F.when(F.col(column).isNotNull(), order))


def prefix_bucket(column: str, buckets: dict[str, str], other: str = "other") -> Column:
    """The bucket of the first prefix a text starts with."""
    out = None
    for prefix, name in buckets.items():
        test = F.startswith(F.col(column), F.lit(prefix))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(other)


def value_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n, top): rows of the most frequent value of each column, null counted as a value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    counts = df.select(F.inline(pairs)).groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column_name").agg(F.sum("n").alias("n"), F.max("n").alias("top"))
