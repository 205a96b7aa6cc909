"""Exact quantiles with linear interpolation, without one task per group and without a full shuffle.

``percentile`` keeps every distinct value of a group in the memory of one task. Here the rows are
counted per (key, value range), which says in which range the wanted positions fall. Only the rows
of those ranges are looked at again, one small sort per (key, range).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import durable
from .ordered import RANGE, cut_points, with_ranges


def _positions(probs: dict[str, float]) -> dict[str, tuple[Column, Column, Column]]:
    """Per name the two neighbouring 0-based positions and the way between them."""
    out = {}
    for name, p in probs.items():
        at = (F.col("_all") - 1) * F.lit(float(p))
        out[name] = (F.floor(at), F.ceil(at), at - F.floor(at))
    return out


def exact_quantiles(df: DataFrame, value: str, probs: dict[str, float], keys: list[str] | None = None) -> DataFrame:
    """One row per key with a column per entry of ``probs`` (name to probability); nulls are skipped."""
    keys = list(keys or [])
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    ranged = with_ranges(rows, "_v", cut_points(rows, "_v").points)
    places = _positions(probs)

    per = ranged.groupBy(*keys, RANGE).agg(F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy(*keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    placed = per.withColumns(
        {"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "_all": F.sum("_rows").over(W.partitionBy(*keys))}
    )
    inside = [
        (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_rows")) for lo, hi, _ in places.values() for rank in (lo, hi)
    ]
    wanted = placed.filter(reduce(lambda a, b: a | b, inside))
    # Written out, so that the planner knows its size when it chooses the join.
    wanted = durable(wanted.select(*[F.col(k).alias(f"_k_{k}") for k in [*keys, RANGE]], "_before", "_all"))
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col(RANGE) == F.col(f"_k_{RANGE}")]
    near = ranged.join(wanted, match)

    group = [*keys, RANGE, "_before", "_all"]
    counts = near.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
    so_far = W.partitionBy(*keys, RANGE).orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    counts = counts.withColumn("_upto", F.col("_before") + F.sum("_n").over(so_far))
    aggs = []
    for name, (lo, hi, part) in places.items():
        for side, rank in (("lo", lo), ("hi", hi)):
            hit = (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
            aggs.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{side}_{name}"))
        aggs.append(F.max(part).alias(f"_f_{name}"))
    picked = counts.groupBy(*keys).agg(*aggs)
    return picked.select(
        *keys,
        *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}")).alias(n) for n in probs],
    )


def with_quantiles(df: DataFrame, value: str, probs: dict[str, float], keys: list[str] | None = None) -> DataFrame:
    """``df`` with the quantiles of its key on every row."""
    keys = list(keys or [])
    # written, so that the planner knows how small it is and need not move the rows to it
    quantiles = durable(exact_quantiles(df, value, probs, keys))
    if keys:
        right = quantiles.withColumnsRenamed({k: f"_q_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_q_{k}")) for k in keys]
        return df.join(right, same, "left").drop(*[f"_q_{k}" for k in keys])
    one = quantiles.select(F.struct(*probs).alias("q")).scalar()
    return df.withColumn("_q", one).select(*df.columns, *[F.col(f"_q.{n}").alias(n) for n in probs])
