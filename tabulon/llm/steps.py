"""Written steps: tables in the shared folder that cut lineage and survive lost executors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tabulon.sources.scratch import scratch_path

#: Spark's setting that drops a query's shuffle files once the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Up to which size a join side is broadcast: as estimated from its files before the run, and as its shuffle has measured.
_ESTIMATED, _MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
#: Rows that a file is worth: making a file takes longer than writing fewer.
FILE_ROWS = 10_000


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    conf = spark.conf
    before = {k: conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)


def write_out(df: DataFrame, path: str, measured: bool = False) -> None:
    """Write ``df`` as Parquet; its shuffle files go when the write has ended, not at some later garbage collection.

    ``measured``: no join side is broadcast on the size of its files, only on the size of its rows as shuffled. Files
    of codes or links are many times smaller than their rows in memory, more so once these are multiplied by a generator.
    """
    spark, values = df.sparkSession, {_CLEANUP: "true"}
    if measured:
        values |= {_MEASURED: spark.conf.get(_MEASURED, None) or spark.conf.get(_ESTIMATED), _ESTIMATED: "-1"}
    with _settings(spark, values):
        df.write.option("compression", "zstd").parquet(path)


class Steps:
    """The written steps of one operator call.

    ``write`` returns the table read back. Where the caller knows about how many ``rows`` a step has at most, it goes to no more files than
    these are worth, but to two per core at least. ``drop`` deletes steps that nothing reads any more; what the
    returned DataFrame still reads stays until the caller clears the shared folder. ``measured``: as in ``write_out``.
    """

    def __init__(self, spark: SparkSession, name: str, measured: bool = False):
        self.spark, self.name, self.measured, self.paths = spark, name, measured, {}

    def write(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        if rows is not None:
            df = df.coalesce(max(2 * self.spark.sparkContext.defaultParallelism, math.ceil(rows / FILE_ROWS)))
        path = scratch_path(self.spark, self.name)
        write_out(df, path, self.measured)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            _, path = self.paths.pop(id(table), (None, None))
            if path:
                jvm = self.spark._jvm
                place = jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
