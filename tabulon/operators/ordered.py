"""Ordered computations (ranks, running sums, neighbours) that do not put a hot key in one task.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. Here the order column is
cut into ranges at approximate quantiles first, so a window partition ``(key, range)`` holds at most
about ``1 / ranges`` of the table whatever the key is. Each range then needs only a small carry from
the ranges before it: one row per ``(key, range)``. A single value that fills whole ranges is cut
again by the tie column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE = "_range"
GROUP = "_group"
ROWS_PER_RANGE = 2_000_000


def micros(ts: Column | str) -> Column:
    """A timestamp as a number of microseconds, usable as an order column."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def range_count(df: DataFrame) -> int:
    """At least one range per shuffle partition; ``cut_points`` makes more when the rows need them."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@dataclass
class Cuts:
    """Where the order column is cut, and the values that fill more than one range alone."""

    points: list[float]
    heavy: list[float]


def cut_points(df: DataFrame, order: str | Column, ranges: int | None = None) -> Cuts:
    """Approximate quantiles of a numeric column, so many that a range holds about ``ROWS_PER_RANGE`` rows at most.

    The driver gets one number per range.
    """
    value = (F.col(order) if isinstance(order, str) else order).cast("double")

    def ask(n: int):
        probs = [i / n for i in range(1, n)]
        row = df.agg(F.percentile_approx(value, probs, 4 * n).alias("q"), F.count(F.lit(1)).alias("n")).head()
        return list(row.q or []), row.n

    n = ranges or range_count(df)
    raw, rows = ask(n)
    if ranges is None and rows > n * ROWS_PER_RANGE:
        raw, _ = ask(-(-rows // ROWS_PER_RANGE))
    heavy = sorted({v for v, w in zip(raw, raw[1:]) if v == w})
    points = sorted(set(raw) | {math.nextafter(v, math.inf) for v in heavy})
    return Cuts(points, heavy)


def as_number(df: DataFrame, column: str) -> Column | None:
    """A number in the order of the column, or null if there is none. Texts are placed by their first six bytes."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return micros(column).cast("double")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(F.col(column), "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    return None


def with_ranges(df: DataFrame, order: str, points: list[float], name: str = RANGE) -> DataFrame:
    """Add the range number of ``order``; equal values share a range and ranges follow the order.

    Rows without an order value come last.
    """
    if not points:
        return df.withColumn(name, F.lit(0))
    key = f"{name}_key"
    cut = Bucketizer(splits=[-math.inf, *points, math.inf], inputCol=key, outputCol=name, handleInvalid="keep")
    ranged = cut.transform(df.withColumn(key, F.col(order).cast("double"))).drop(key)
    return ranged.withColumn(name, F.coalesce(F.col(name).cast("int"), F.lit(len(points) + 1)))


@dataclass
class Ordered:
    """What to compute per key in the order ``order, tie``; each map is output name to input."""

    order: str
    keys: list[str] = field(default_factory=list)
    tie: list[str] = field(default_factory=list)
    row_number: str | None = None
    running: dict[str, tuple[str, str]] = field(default_factory=dict)  # out -> (sum|count|min|max, column)
    total: dict[str, tuple[str, str]] = field(default_factory=dict)
    lag: dict[str, str] = field(default_factory=dict)
    lead: dict[str, str] = field(default_factory=dict)


_AGG = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _ranged(df: DataFrame, spec: Ordered, cuts: Cuts) -> DataFrame:
    out = with_ranges(df, spec.order, cuts.points)
    tie = as_number(df, spec.tie[0]) if cuts.heavy and spec.tie else None
    if tie is None:
        return out
    out = out.withColumn("_tie", tie)
    inner = cut_points(out, "_tie")
    out = with_ranges(out, "_tie", inner.points, "_sub")
    step = len(inner.points) + 2
    sub = F.when(F.col(spec.order).cast("double").isin(cuts.heavy), F.col("_sub")).otherwise(F.lit(0))
    return out.withColumn(RANGE, F.col(RANGE) * step + sub).drop("_sub", "_tie")


def ordered(df: DataFrame, spec: Ordered, cuts: Cuts | None = None) -> DataFrame:
    """Add the columns of ``spec`` to every row of ``df``.

    Values of a running aggregate follow the rows one by one; where ``order`` and ``tie`` leave rows
    equal, which of them comes first is open. ``with_peers`` gives equal rows the same values.
    """
    ranged = _ranged(df, spec, cuts or cut_points(df, spec.order))
    # One struct stands for the keys: its equality holds for null keys too and is plain, so the join
    # with the carried values uses the partitioning of the window and rows are shuffled once.
    if spec.keys:
        ranged = ranged.withColumn(GROUP, F.struct(*spec.keys))
    group = [GROUP] if spec.keys else []
    keys = [*group, RANGE]
    local_order = W.partitionBy(*keys).orderBy(spec.order, *spec.tie)
    so_far = local_order.rowsBetween(W.unboundedPreceding, 0)
    at = F.struct(spec.order, *spec.tie)

    local, carry = {}, {"_rows": F.count(F.lit(1))}
    if spec.row_number or spec.lag:
        local["_l_number"] = F.row_number().over(local_order)
    if spec.lead:
        local["_l_last"] = F.lead(F.lit(1)).over(local_order).isNull()
    for out, (kind, column) in spec.running.items():
        local[f"_l_{out}"] = _AGG[kind](column).over(so_far)
    for out, (kind, column) in {**spec.running, **spec.total}.items():
        carry[f"_c_{out}"] = _AGG[kind](column)
    for out, column in spec.lag.items():
        local[f"_l_{out}"] = F.lag(column).over(local_order)
        carry[f"_c_{out}"] = F.max_by(F.struct(F.col(column).alias("v")), at)
    for out, column in spec.lead.items():
        local[f"_l_{out}"] = F.lead(column).over(local_order)
        carry[f"_c_{out}"] = F.min_by(F.struct(F.col(column).alias("v")), at)

    ranges = ranged.groupBy(*keys).agg(*[c.alias(n) for n, c in carry.items()])
    in_key = W.partitionBy(*group).orderBy(RANGE)
    before = in_key.rowsBetween(W.unboundedPreceding, -1)
    offsets = {"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0))}
    for out, (kind, _) in spec.running.items():
        offsets[f"_o_{out}"] = _MERGE[kind](f"_c_{out}").over(before)
    for out, (kind, _) in spec.total.items():
        offsets[f"_o_{out}"] = _MERGE[kind](f"_c_{out}").over(W.partitionBy(*group))
    for out in spec.lag:
        offsets[f"_o_{out}"] = F.lag(f"_c_{out}").over(in_key)
    for out in spec.lead:
        offsets[f"_o_{out}"] = F.lead(f"_c_{out}").over(in_key)
    carried = ranges.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c.alias(n) for n, c in offsets.items()])

    rows = ranged.withColumns(local) if local else ranged
    joined = rows.join(carried, [F.col(k) == F.col(f"_k_{k}") for k in keys], "inner")

    result = [F.col(c) for c in df.columns]
    if spec.row_number:
        result.append((F.col("_before") + F.col("_l_number")).alias(spec.row_number))
    for out, (kind, _) in spec.running.items():
        here, old = F.col(f"_l_{out}"), F.col(f"_o_{out}")
        if kind in ("sum", "count"):
            result.append(F.coalesce(old + here, here, old).alias(out))
        else:
            result.append((F.least if kind == "min" else F.greatest)(here, old).alias(out))
    for out in spec.total:
        result.append(F.col(f"_o_{out}").alias(out))
    for out in spec.lag:
        result.append(F.when(F.col("_l_number") == 1, F.col(f"_o_{out}.v")).otherwise(F.col(f"_l_{out}")).alias(out))
    for out in spec.lead:
        result.append(F.when(F.col("_l_last"), F.col(f"_o_{out}.v")).otherwise(F.col(f"_l_{out}")).alias(out))
    return joined.select(*result)


def _by_value(df: DataFrame, placed: DataFrame, keys: list[str], order: str, out: list[str]) -> DataFrame:
    """Join columns of the distinct (keys, order) of ``placed`` to the rows of ``df``.

    The right side has one row per value, so the planner can split the rows of a value that is hot.
    """
    match = F.struct(*[F.col(k) for k in [*keys, order]])
    right = placed.select(F.struct(*[F.col(k) for k in [*keys, order]]).alias("_k"), *out)
    return df.withColumn("_v", match).join(right, F.col("_v") == F.col("_k"), "inner").select(*df.columns, *out)


def with_peers(df: DataFrame, spec: Ordered) -> DataFrame:
    """Running and total aggregates of ``spec`` where rows equal in ``order`` count together, as in the default frame of SQL.

    The rows of a value are aggregated first, the running values go over the values and are joined back.
    """
    inputs = {**spec.running, **spec.total}
    values = df.groupBy(*spec.keys, spec.order).agg(*[_AGG[kind](column).alias(f"_p_{out}") for out, (kind, column) in inputs.items()])
    merge = lambda outs: {out: ("sum" if kind == "count" else kind, f"_p_{out}") for out, (kind, _) in outs.items()}
    placed = ordered(values, Ordered(order=spec.order, keys=spec.keys, running=merge(spec.running), total=merge(spec.total)))
    return _by_value(df, placed, spec.keys, spec.order, list(inputs))


def ranked(
    df: DataFrame, order: str, keys: list[str] | None = None, rank: str | None = None, dense_rank: str | None = None
) -> DataFrame:
    """Rank with and without gaps, ties equal. Ranks are found on distinct values and joined back."""
    keys = list(keys or [])
    counts = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_n"))
    placed = ordered(
        counts, Ordered(order=order, keys=keys, row_number="_dense", running={"_upto": ("sum", "_n")}), cut_points(df, order)
    )
    out = {}
    if rank:
        out[rank] = F.col("_upto") - F.col("_n") + 1
    if dense_rank:
        out[dense_rank] = F.col("_dense")
    return _by_value(df, placed.withColumns(out), keys, order, list(out))


def stable_hash(*columns: str, seed: int = 0) -> Column:
    """A repeatable pseudo-random long per row; the same under any partitioning."""
    return F.xxhash64(*[F.col(c) for c in columns], F.lit(seed))
