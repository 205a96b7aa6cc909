"""Mixing sources to target weights by entropy balancing.

Of all document rates between 0 and ``cap`` whose words meet each source's target, the one nearest to
"every document once" in relative entropy is ``min(cap, exp(l * size / mean size))``, with one
multiplier ``l`` per source. The multipliers solve a convex dual: Newton iterations, each one aggregate
over the counts per (source, size), kept inside a bracket. Rates then become whole copies. Documents
of one source and size are interchangeable, so copies are rounded per such group, largest size
first, each group paying back what the larger ones left over; the extra copies go to the documents
with the smallest hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .steps import Steps

WEIGHTS = (1, 2, 3)
CAP = 3
GROUP = 256
ROUNDS = 200
TOLERANCE = 1e-9


def word_count(text: str | Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; null counts 0."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def numbered(sources: DataFrame, steps: Steps) -> DataFrame:
    """Adds number: 0, 1, ... in code point order of source, null last, without gathering the sources in one task."""
    placed = steps.write(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("place", F.monotonically_increasing_id()))
    part, inner = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("part", before.alias("before"))  # a row per file of the sorted table
    return placed.withColumn("part", part).join(offsets, "part").withColumn("number", F.col("before") + inner).drop("part", "before", "place")


def targets(sources: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Adds target (double) to (number, source_size): weights share the total, capped at ``cap`` times the size, the excess reshared."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("number", F.lit(len(weights))) + 1).cast("int"))
    sources = sources.withColumn("weight", weight)
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    full = F.col("source_size") * cap
    share, per = None, 0.0
    while per != share:  # the share per weight only grows, so each round fills at least one more source
        share = per
        over = F.col("weight") * F.lit(share) > full
        row = sources.agg(F.sum(F.when(over, full).otherwise(0)).alias("full"), F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weights")).first()
        per = max(share, (total - row["full"]) / row["weights"]) if row["weights"] else share
    return sources.withColumn("target", F.least(full.cast("double"), F.col("weight") * F.lit(float(share))))


def multipliers(counts: DataFrame, sources: DataFrame, cap: int, steps: Steps) -> DataFrame:
    """(number, lambda, mean): the dual solution of every source with words.

    ``counts``: number, size (above 0), docs. Below rate 1 the dual's slope is convex and Newton from 0
    descends to the root; above it the caps make kinks, so a step that leaves the bracket is replaced by
    its middle. Raises if a source is not solved after ``ROUNDS`` rounds.
    """
    sums = counts.groupBy("number").agg((F.sum(F.col("docs") * F.col("size")) / F.sum("docs")).alias("mean"), F.min("size").alias("least"))
    state = sources.filter("source_size > 0").join(sums, "number").select(
        "number", "mean", "target", (F.col("target") >= F.col("source_size") * cap).alias("full"),
        F.when(F.col("target") >= F.col("source_size"), 0.0).otherwise(-math.inf).alias("lo"),
        F.when(F.col("target") < F.col("source_size"), 0.0).otherwise(F.col("mean") * math.log(cap) / F.col("least")).alias("hi"),
    )
    state = state.withColumn("lambda", F.when(F.col("full"), F.col("hi")).otherwise(F.lit(0.0))).withColumn("done", F.col("full")).drop("full")
    state = steps.write(state)
    for _ in range(ROUNDS):
        if state.filter("not done").isEmpty():
            return state.select("number", "lambda", "mean")
        words, tilt = F.col("docs") * F.col("size"), F.exp(F.least(F.col("lambda") * F.col("size") / F.col("mean"), F.lit(50.0)))
        now = counts.join(state.filter("not done"), "number").groupBy("number").agg(
            F.sum(words * F.least(tilt, F.lit(float(cap)))).alias("got"),
            F.sum(F.when(tilt < cap, words * tilt * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
        )
        s = state.join(now, "number", "left")
        gap = F.col("got") - F.col("target")
        s = s.withColumn("done", F.col("done") | (F.abs(gap) <= TOLERANCE * F.col("target")) | (F.col("hi") - F.col("lo") <= 1e-15 * F.abs("hi")))
        s = s.withColumn("lo", F.when(gap < 0, F.col("lambda")).otherwise(F.col("lo"))).withColumn("hi", F.when(gap > 0, F.col("lambda")).otherwise(F.col("hi")))
        step = F.col("lambda") - gap / F.nullif(F.col("slope"), F.lit(0.0))
        middle = F.when(F.col("lo") == -math.inf, F.col("hi") * 2 - 1).otherwise((F.col("lo") + F.col("hi")) / 2)
        inside = (step > F.col("lo")) & (step < F.col("hi"))
        s = s.withColumn("lambda", F.when(F.col("done"), F.col("lambda")).when(inside, step).otherwise(middle)).drop("got", "slope")
        after = steps.write(s)
        steps.drop(state)
        state = after
    raise RuntimeError("entropy balancing did not converge")


def _whole_copies(cap: int):
    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size", ascending=False)
        owed, out = 0.0, []
        for size, docs, rate in zip(group["size"], group["docs"], group["rate"]):
            owed += size * docs * rate
            copies = int(min(cap * docs, max(0, math.floor(owed / size + 0.5))))
            owed -= copies * size
            out.append(copies)
        return group[["number", "size", "docs"]].assign(copies=np.array(out, np.int64))

    return fold


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs`` (doc_id, source, text).

    ``size`` counts words, null and empty texts have 0 and are never taken. Sources take the weights in
    turn by code point order, a null source is one source and comes last. ``taken`` is copies * size and at
    most ``cap`` times the size. Rows that repeat a doc_id are documents of their own. An empty table gives an empty result.
    The columns in ``keep`` travel with their row and come last; they must not be named like one of these.
    """
    steps = Steps(docs.sparkSession, "mix")
    rank = F.xxhash64("doc_id", "source", "text")  # rows without a doc_id differ by their text
    sized = steps.write(docs.select("doc_id", "source", word_count("text").alias("size"), rank.alias("rank"), *keep))
    name = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    by_size = steps.write(sized.groupBy("source", "size").agg(F.count("*").alias("docs")))
    sources = by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    sources = steps.write(targets(steps.write(numbered(sources, steps)), weights, cap).withColumn("name", name))
    counts = by_size.filter("size > 0").withColumn("name", name).join(sources.select("name", "number"), "name").select("number", "size", "docs")
    counts = steps.write(counts)
    dual = multipliers(counts, sources, cap, steps)
    rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("lambda") * F.col("size") / F.col("mean"), F.lit(50.0))))
    rated = counts.join(dual, "number").select("number", "size", "docs", rate.alias("rate"))
    # a group holds one row per distinct size of the source: as long as its longest text at most, not as its rows
    copies = rated.groupBy("number").applyInPandas(_whole_copies(cap), "number long, size long, docs long, copies long")
    copies = steps.write(copies.withColumn("parts", F.ceil(F.col("docs") / GROUP).cast("long")))

    rows = sized.withColumn("name", name).join(sources.select("name", "number", "source_size", "target"), "name").drop("name")
    rows = rows.join(copies, ["number", "size"], "left")
    rows = rows.withColumn("part", F.coalesce(F.pmod("rank", F.col("parts")), F.lit(0)))
    group = W.partitionBy("number", "size", "part").orderBy("rank", "doc_id")
    chosen = rows.filter("copies % docs > 0")
    sub = chosen.groupBy("number", "size", "part").agg(F.count("*").alias("here"), F.first("docs").alias("docs"), (F.first("copies") % F.first("docs")).alias("extra"))
    upto = F.sum("here").over(W.partitionBy("number", "size").orderBy("part"))
    quota = F.expr("extra * upto div docs - extra * (upto - here) div docs")
    sub = sub.withColumn("upto", upto).select("number", "size", "part", quota.alias("quota"))
    more = chosen.withColumn("at", F.row_number().over(group)).join(sub, ["number", "size", "part"])
    more = more.withColumn("n", F.expr("copies div docs") + F.when(F.col("at") <= F.col("quota"), 1).otherwise(0))
    same = rows.filter("copies is null or copies % docs = 0").withColumn("n", F.coalesce(F.expr("copies div docs"), F.lit(0)))
    columns = ["doc_id", "source", "size", "source_size", "target", F.col("n").cast("long").alias("copies"), (F.col("n") * F.col("size")).cast("long").alias("taken"), *keep]
    return same.select(*columns).union(more.select(*columns))
