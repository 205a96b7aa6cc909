"""MinHash near-duplicates by a signature-coordinate inverted join.

Every distinct shingle set gets a signature of ``COORDINATES`` minima and is posted under its
(coordinate, value) pairs. Two sets whose Jaccard similarity is at the threshold agree in about that
share of the coordinates, so they agree in ``least_matches`` of them but for a chance below one in a million.
Sets with so many agreements share one of their ``COORDINATES - matches + 1`` rarest pairs, whatever
they are (prefix merging); the frequent pairs beyond that prefix are never joined (skip merging), they
only count in the comparison of the whole signatures. Pairs with enough agreements are confirmed on
the full sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.joins import join_hot

from .graph import bucket_components
from .steps import Steps
from .words import text_shingles

WIDTH = 5
COORDINATES = 64
PERCENT = 85
#: Chance at most that a pair at the threshold has too few agreements.
LOSS = 1e-6


def least_matches(percent: int, coordinates: int) -> int:
    """The agreements that a pair at the threshold has but for a chance below ``LOSS``."""
    p, fewer = percent / 100, 0.0
    for m in range(coordinates):
        fewer += math.comb(coordinates, m) * p**m * (1 - p) ** (coordinates - m)
        if fewer >= LOSS:
            return max(1, m)
    return coordinates


def signatures(docs: DataFrame, coordinates: int = COORDINATES, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, signature) of every row of ``docs`` (doc_id, text)."""

    def work(batches):
        for batch in batches:
            for lo, hi, sets in text_shingles(batch.column(1), width):
                a, b = sets.set_ids()
                grid = sets.signatures(coordinates)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0).slice(lo, hi - lo),
                        "n_shingles": pa.array(sets.sizes().astype(np.int64)),
                        "set_a": pa.array(a.view(np.int64)),
                        "set_b": pa.array(b.view(np.int64)),
                        "signature": pa.FixedSizeListArray.from_arrays(pa.array(grid.ravel()), coordinates).cast(pa.list_(pa.int32())),
                    }
                )

    kind = "doc_id long, n_shingles long, set_a long, set_b long, signature array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, kind)


def shingle_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(set_a, set_b, shingles): the two hashes and the full set of every row of ``docs`` (text), as 64-bit hashes."""

    def work(batches):
        for batch in batches:
            for _, _, sets in text_shingles(batch.column(0), width):
                a, b = sets.set_ids()
                lists = pa.LargeListArray.from_arrays(pa.array(sets.bounds.astype(np.int64)), pa.array(sets.hashes.view(np.int64)))
                yield pa.record_batch({"set_a": pa.array(a.view(np.int64)), "set_b": pa.array(b.view(np.int64)), "shingles": lists.cast(pa.list_(pa.int64()))})

    return docs.select("text").mapInArrow(work, "set_a long, set_b long, shingles array<long>")


def enough(shared, left, right, percent: int):
    """100 * intersection >= percent * union, in whole numbers."""
    return 100 * shared >= percent * (left + right - shared)


def near_duplicates(
    docs: DataFrame, percent: int = PERCENT, coordinates: int = COORDINATES, matches: int | None = None, width: int = WIDTH
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, anything else).

    Words are lower-cased (A-Z) runs without ASCII white space; a set holds the distinct runs of
    ``width`` words, or the whole sequence of a shorter text. Null, empty and wordless texts have the
    empty set and link with nothing. Equal sets always share a component. A null doc_id takes part in
    no link: its component is null and it is kept. Rows that repeat a doc_id with the same text get
    equal results; with another text they are documents of their own, each with its own links.
    ``component_id`` is the smallest doc_id reachable over links.
    ``matches`` agreements are asked of a pair, by default ``least_matches``.
    """
    matches = matches or least_matches(percent, coordinates)
    steps = Steps(docs.sparkSession, "near")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = steps.write(signatures(docs, coordinates, width))
    n = signed.count()
    real = signed.filter("n_shingles > 0 and doc_id is not null")
    # a set is named by its two hashes, and by a number for short; the written table keeps the numbers as they are
    heads = real.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("head")).withColumn("item", F.monotonically_increasing_id())
    heads = steps.write(heads, n)
    items = heads.join(real, ["set_a", "set_b"]).filter("doc_id = head").select("item", "set_a", "set_b", "head", "n_shingles", "signature").distinct()
    items = steps.write(items, n)

    pairs = items.select("item", F.posexplode("signature").alias("at", "value")).select("item", F.xxhash64("at", "value").alias("key"))
    shared = pairs.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = pairs.join(shared, "key").groupBy("item").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("pairs"))
    prefix = F.slice("pairs", 1, F.greatest(F.lit(0), F.size("pairs") - F.lit(matches) + 1))
    ranked = ranked.select("item", F.transform(prefix, lambda p: p["key"]).alias("prefix"), F.aggregate("pairs", F.lit(0).cast("long"), lambda s, p: s + p["n"]).alias("weight"))
    ranked = steps.write(ranked.filter("size(prefix) > 0"), n)

    # full sets of the candidates, and how many of its shingles each shares with any other of them
    # the candidates grow with the corpus, so texts and candidates meet by a shuffle at every size
    wanted = items.join(ranked.select("item"), "item").select(F.col("head").alias("doc_id")).distinct()
    texts = docs.join(wanted.hint("merge"), "doc_id")
    named = items.select("set_a", "set_b", "item", "n_shingles", "signature")
    sets = shingle_sets(texts, width).join(named, ["set_a", "set_b"]).dropDuplicates(["set_a", "set_b"]).drop("set_a", "set_b")
    sets = steps.write(sets, n)
    alone = sets.select("item", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"), F.max("item").alias("item")).filter("n = 1")
    alone = alone.groupBy("item").agg(F.count("*").alias("alone"))
    known = ranked.join(sets.select("item", "n_shingles"), "item").join(alone, "item", "left")
    known = known.withColumn("shared", F.col("n_shingles") - F.coalesce("alone", F.lit(0))).drop("alone")
    known = steps.write(known.filter(100 * F.col("shared") >= percent * F.col("n_shingles")), n)
    posts = known.select("item", "weight", F.explode("prefix").alias("key"))

    def verify(found: DataFrame) -> DataFrame:
        left = sets.select(F.col("item").alias("a"), F.col("shingles").alias("sa"), F.col("n_shingles").alias("na"), F.col("signature").alias("ga"))
        right = sets.select(F.col("item").alias("b"), F.col("shingles").alias("sb"), F.col("n_shingles").alias("nb"), F.col("signature").alias("gb"))
        both = found.join(left, "a").join(right, "b")
        agree = F.size(F.filter(F.arrays_zip("ga", "gb"), lambda z: z["ga"] == z["gb"])) >= matches
        holds = enough(F.size(F.array_intersect("sa", "sb")), F.col("na"), F.col("nb"), percent)
        return both.filter(agree & holds).select("a", "b")

    # no more can be common than either set has in common with any other; a pair meets under its first common key
    fits = enough(F.least("x.shared", "y.shared"), F.col("x.n_shingles"), F.col("y.n_shingles"), percent) & (
        F.element_at(F.array_intersect("x.prefix", "y.prefix"), 1) == F.col("x.key")
    )
    group = bucket_components(posts, verify, steps, known.drop("weight"), fits)
    steps.drop(ranked, sets, known, items)

    # only linked sets meet by component, and a component with a large share of them is split
    lowest = heads.join(group, "item").groupBy("component").agg(F.min("head").alias("lowest"))
    named = join_hot(group, lowest, "component").select("item", "lowest")
    known = heads.join(named, "item", "left").select("set_a", "set_b", F.coalesce("lowest", "head").alias("component"))
    rows = signed.select("doc_id", "n_shingles", "set_a", "set_b")
    linked = F.col("n_shingles") > 0
    out = rows.join(known, ["set_a", "set_b"], "left").withColumn("component_id", F.when(F.col("doc_id").isNull(), None).when(linked, F.col("component")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
