"""Reading and writing tables: delimited text, JSON, parquet, cached builds, scan guard."""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Callable

import pandas as pd
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import finite_columns


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    columns: list[str] | None = None,
    missing: str = "",
) -> DataFrame:
    """Delimited text with a stated schema; nothing is inferred, so the files are read once."""
    df = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("encoding", encoding)
        .option("nullValue", missing)
        .csv(path)
    )
    return df.select(*columns) if columns else df


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> str:
    df.write.mode("errorifexists").option("header", header).option("sep", sep).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """JSON Lines, one object per row."""
    df.write.mode("errorifexists").json(path)
    return path


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int, partitions: int, **options
) -> DataFrame:
    """A database table read in parallel by ranges of a numeric column. Needs the driver's jar on the class path."""
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions, properties=options
    )


def _value_reaching(df: DataFrame, column: str, n: int, bins: int = 4096, rounds: int = 8):
    """A value with at least ``n`` rows at or below it and, after a few passes, not many more."""
    x = F.col(column)
    low, high, rows = df.agg(F.min(x), F.max(x), F.count(x)).head()
    for _ in range(rounds):
        if rows is None or rows <= 2 * n or low == high:
            break
        width = (float(high) - float(low)) / bins
        place = F.least(F.floor((x.cast("double") - float(low)) / width), F.lit(bins - 1))
        counts = df.filter(x <= high).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("k"), F.max(x).alias("top"))
        rows, top = 0, high
        for r in sorted(counts.collect(), key=lambda r: r.bin):
            rows, top = rows + r.k, r.top
            if rows >= n:
                break
        if top == high:
            break
        high = top
    return high


def first_rows(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by a stated order, nulls first.

    A top-n step gathers n rows of every task in one. For a large n the rows that cannot be among
    them are filtered out before, by a few counting passes over the first key.
    """
    if isinstance(df.schema[key[0]].dataType, T.NumericType):
        bound = _value_reaching(df, key[0], n)
        if bound is not None:
            df = df.filter(F.col(key[0]).isNull() | (F.col(key[0]) <= F.lit(bound)))
    return df.orderBy(*key).limit(n)


def describe_tables(frames: dict[str, DataFrame]) -> list[tuple[str, str, str, bool]]:
    """(table, column, type, nullable) per column, from the schemas only."""
    return [
        (name, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in frames.items()
        for f in df.schema.fields
    ]


def list_tables(spark: SparkSession, folder: str) -> list[str]:
    """Names of the Parquet tables in a folder of any file system that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    names = [f.getPath().getName() for f in found]
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet"))


def examples(df: DataFrame) -> dict[str, str]:
    """The smallest value of every column as text: a preview that is the same in every run."""
    row = df.agg(*[F.min(F.col(c).cast("string")).alias(c) for c in df.columns]).head()
    return row.asDict()


def scan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the bytes all scans of a plan read; runs nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def guarded(df: DataFrame, limit_bytes: int) -> DataFrame:
    """``df``, refused before it runs when its estimated size is above the limit."""
    size = scan_bytes(df)
    if size > limit_bytes:
        raise ValueError(f"estimated {size} bytes, limit {limit_bytes}")
    return df


def parquet_footers(df: DataFrame) -> DataFrame:
    """(file, row_group, rows, column, bytes, low, high, low_text, high_text): one row per column chunk of the Parquet files that ``df`` reads.

    The footers are read in tasks, no data is. ``low`` and ``high`` are the bounds that the writer left: numbers as they are, dates and
    times as microseconds, texts in the two text columns; null where there are none. A nested column's chunks carry its name.
    """
    spark = df.sparkSession
    files = spark.createDataFrame([(f,) for f in df.inputFiles()], "file string")

    def number(v):
        if isinstance(v, datetime.datetime):
            return float(round((v - datetime.datetime(1970, 1, 1, tzinfo=v.tzinfo)) / datetime.timedelta(microseconds=1)))
        if isinstance(v, datetime.date):
            return float((v - datetime.date(1970, 1, 1)).days * 86_400_000_000)
        return float(v) if isinstance(v, (int, float, decimal.Decimal)) and not isinstance(v, bool) else None

    def work(parts):
        for part in parts:
            out = []
            for file in part["file"]:
                place, path = pyarrow.fs.FileSystem.from_uri(file)
                with place.open_input_file(path) as source:
                    footer = pyarrow.parquet.ParquetFile(source).metadata
                    for g in range(footer.num_row_groups):
                        group = footer.row_group(g)
                        for c in range(group.num_columns):
                            chunk = group.column(c)
                            bounds = chunk.statistics
                            low, high = (bounds.min, bounds.max) if bounds is not None and bounds.has_min_max else (None, None)
                            texts = [v if isinstance(v, str) else None for v in (low, high)]
                            name = chunk.path_in_schema.split(".")[0]
                            out.append((file, g, group.num_rows, name, chunk.total_compressed_size, number(low), number(high), *texts))
            yield pd.DataFrame(out, columns=["file", "row_group", "rows", "column", "bytes", "low", "high", "low_text", "high_text"])

    kind = "file string, row_group int, rows long, column string, bytes long, low double, high double, low_text string, high_text string"
    return files.repartition(spark.sparkContext.defaultParallelism).mapInPandas(work, kind)


def scan_estimate(footers: DataFrame, columns: list[str] | None = None, between: dict[str, tuple] | None = None) -> DataFrame:
    """(bytes, row_groups, rows) that a scan of ``columns`` reads, all if none are named, less the row groups whose bounds lie outside ``between``.

    ``between`` maps a column to an inclusive range; either end may be None, times are microseconds. A row group without bounds is read.
    """
    kept = footers
    for column, (lo, hi) in (between or {}).items():
        text = any(isinstance(v, str) for v in (lo, hi))
        low, high = (F.col("low_text"), F.col("high_text")) if text else (F.col("low"), F.col("high"))
        outside = F.lit(False)
        if lo is not None:
            outside = outside | (high < F.lit(lo))
        if hi is not None:
            outside = outside | (low > F.lit(hi))
        gone = footers.filter((F.col("column") == column) & outside).select("file", "row_group").distinct()
        kept = kept.join(gone, ["file", "row_group"], "left_anti")
    wanted = kept if columns is None else kept.filter(F.col("column").isin(list(columns)))
    groups = wanted.groupBy("file", "row_group").agg(F.sum("bytes").alias("bytes"), F.max("rows").alias("rows"))
    return groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count("*").alias("row_groups"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


def guarded_scan(df: DataFrame, limit_bytes: int, columns: list[str] | None = None, between: dict[str, tuple] | None = None) -> DataFrame:
    """The ``columns`` of a Parquet scan, refused before it runs when the footers say that it reads more than the limit.

    The footers rule out row groups by ``between``; the filter itself stays the caller's.
    """
    size = scan_estimate(parquet_footers(df), columns, between).head()["bytes"]
    if size > limit_bytes:
        raise ValueError(f"{size} bytes to read, limit {limit_bytes}")
    return df.select(*columns) if columns else df


def is_complete(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def cached_table(spark: SparkSession, folder: str, group: str, version: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read a finished table of (group, version), or build it, turn infinities to null, and write it."""
    path = f"{folder}/{group}/{version}"
    if not is_complete(spark, path):
        finite_columns(build()).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fill_numeric(df: DataFrame, value: float) -> DataFrame:
    return df.fillna(value)


def read_profile_json(spark: SparkSession, path: str) -> DataFrame:
    """A profile document ``{"variables": {name: {...}}}`` as one row per variable."""
    stats = (
        "type STRING, n BIGINT, n_missing BIGINT, p_missing DOUBLE, n_distinct BIGINT, p_distinct DOUBLE, "
        "is_unique BOOLEAN, min DOUBLE, max DOUBLE, mean DOUBLE, std DOUBLE, skewness DOUBLE, p_zeros DOUBLE, "
        "value_counts_without_nan MAP<STRING, BIGINT>"
    )
    doc = spark.read.option("multiLine", True).schema(f"variables MAP<STRING, STRUCT<{stats}>>").json(path)
    return doc.select(F.explode("variables").alias("variable", "s")).select("variable", "s.*")
