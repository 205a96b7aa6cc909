"""Column expressions shared by the jobs. All of them stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """``num / den``, null when the divisor is zero or null."""
    return col(num) / F.nullif(col(den), F.lit(0))


def sentinel_to_null(c: Column | str, value) -> Column:
    return F.nullif(col(c), F.lit(value))


def finite(c: Column | str) -> Column:
    """Infinities and NaN become null."""
    c = col(c)
    bad = c.isin(float("inf"), float("-inf")) | F.isnan(c)
    return F.when(~bad, c)


def finite_columns(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: finite(n) for n in floats}) if floats else df


def clip(c: Column | str, low=None, high=None) -> Column:
    """Keep a value inside [low, high]; null stays null (``greatest`` would skip it)."""
    c = col(c)
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def flag(cond: Column) -> Column:
    """1 when the test holds, 0 when it does not or cannot be decided."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def row_array(columns: list[str]) -> Column:
    """The non-null values of several columns of one row as an array of doubles."""
    return F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda x: x.isNotNull())


def row_count(columns: list[str]) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))


def row_total(columns: list[str], min_count: int = 0) -> Column:
    """Sum over columns, nulls as 0; with ``min_count=1`` an all-null row gives null."""
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0))
    return total if min_count == 0 else F.when(row_count(columns) >= min_count, total)


def row_mean(columns: list[str]) -> Column:
    return safe_divide(row_total(columns), row_count(columns))


def row_min(columns: list[str]) -> Column:
    return F.least(*[F.col(c) for c in columns]) if len(columns) > 1 else F.col(columns[0])


def row_max(columns: list[str]) -> Column:
    return F.greatest(*[F.col(c) for c in columns]) if len(columns) > 1 else F.col(columns[0])


def row_std(columns: list[str]) -> Column:
    """Population standard deviation over the non-null values of one row."""
    mean = row_mean(columns)
    squares = sum(
        (F.coalesce(F.pow(F.col(c).cast("double") - mean, 2), F.lit(0.0)) for c in columns), F.lit(0.0)
    )
    return F.sqrt(safe_divide(squares, row_count(columns)))


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def contains_text(c: Column | str, word: str) -> Column:
    """Case-insensitive substring test; null counts as no match."""
    return F.coalesce(F.contains(F.lower(col(c)), F.lit(word.lower())), F.lit(False))


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().replace(" ", "_").lower() for c in df.columns])


def present(df: DataFrame, columns: list[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order, each once."""
    have = set(df.columns)
    return [c for c in dict.fromkeys(columns) if c in have]


def has_all(df: DataFrame, columns: list[str]) -> bool:
    return set(columns) <= set(df.columns)


def columns_like(df: DataFrame, prefix: str | tuple = "", suffix: str | tuple = "", numeric: bool = False) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if f.name.startswith(prefix) and f.name.endswith(suffix) and (not numeric or isinstance(f.dataType, T.NumericType))
    ]


def align(df: DataFrame, saved: dict[str, str]) -> DataFrame:
    """Exactly the saved columns (name to type); absent ones are null."""
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in saved.items()])


def first_of_each_name(frames: list[DataFrame], key: str, how: str = "left") -> DataFrame:
    """Join frames side by side on ``key``; of a repeated name the first copy wins."""
    out = frames[0]
    for other in frames[1:]:
        new = [c for c in other.columns if c == key or c not in set(out.columns)]
        out = out.join(other.select(*new), key, how)
    return out


def category_frame(df: DataFrame, categories: list[str], missing: str = "__MISSING__") -> DataFrame:
    """Numbers as float, categories as text with a word for null."""
    out = []
    for f in df.schema.fields:
        if f.name in categories:
            out.append(F.coalesce(F.col(f.name).cast("string"), F.lit(missing)).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            out.append(F.col(f.name).cast("float").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
