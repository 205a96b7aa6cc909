"""Links between items of shared buckets, and connected components, without pairing whole groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .steps import Steps


def components(links: DataFrame, steps: Steps, rows: int | None = None) -> DataFrame:
    """(item, component): every linked item with the smallest item it reaches. ``links`` has columns a, b.

    Alternates two rewritings of the links until every item is tied to one other and that one to none: every item's larger
    neighbours are tied to its smallest neighbour, then its smaller ones are. Each is one aggregate and one join, so a
    neighbour list is never held together and a hub's rows can be split. Rounds grow with the
    logarithm of the longest path; links that are stars already take none. Self links and repeated links do no harm.
    ``rows``: how many links there are at most, if known.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = steps.write(edges, rows)
    while True:
        ends = edges.select(F.col("a").alias("item"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("item").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        rows, more = ends.agg(F.sum("up"), F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()
        if not more:
            break
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").filter("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        tied = large.join(low, "a")
        small = tied.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        after = steps.write(small.distinct(), rows)
        steps.drop(edges)
        edges = after
    roots = edges.select(F.col("b").alias("item"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("item"), F.col("b").alias("component")).union(roots)


def bucket_components(
    posts: DataFrame, verify: Callable[[DataFrame], DataFrame], steps: Steps, known: DataFrame | None = None, also: Column | None = None, split: int | None = None
) -> DataFrame:
    """(item, component) of the items that verified pairs sharing a bucket connect, as ``components`` of all those pairs would give.

    ``posts``: key, item, weight, one row per bucket and item. ``verify`` takes pairs (a, b) and returns those that hold.

    First every item meets the heaviest item of each of its buckets. A group of near copies is thus
    mostly connected through its centre with one pair per item. Then only pairs of a bucket that are
    still in different components are compared, all of them, so no connection is lost. ``also``
    rules out pairs that cannot hold, by what is ``known`` of the two items (aliases x, y). With ``split``, of a key with
    more open rows a task has ``split`` at a time to compare with all of the key.
    """
    n = posts.count()
    hubs = posts.groupBy("key").agg(F.max_by("item", F.struct("weight", -F.col("item"))).alias("hub"), F.min("item").alias("lo"), F.max("item").alias("hi"))
    hubs = steps.write(hubs.filter("lo < hi").select("key", "hub"), n)
    met = steps.write(posts.select("key", "item").join(hubs, "key"), n)
    first = met.filter("item <> hub").select(F.least("item", "hub").alias("a"), F.greatest("item", "hub").alias("b")).distinct()
    links = steps.write(verify(first))
    label = steps.write(components(links, steps, n), n)
    rows = met.join(label, "item", "left").select("key", "item", F.coalesce("component", "item").alias("component"))
    open_keys = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key")
    left = rows.join(open_keys, "key")
    left = steps.write(left if known is None else left.join(known, "item"), n)
    one, other, same = left, left, F.col("x.key") == F.col("y.key")
    if split is not None:
        parts = F.ceil(F.col("_n") / split).cast("int")
        sizes = steps.write(left.groupBy("key").agg(F.count("*").alias("_n")), n)
        sized = left.join(sizes, "key")
        one = sized.withColumn("_part", F.pmod(F.xxhash64("item"), parts).cast("int")).drop("_n")
        other = sized.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_n")
        same = same & (F.col("x._part") == F.col("y._part"))
    x, y = one.alias("x"), other.alias("y")
    match = same & (F.col("x.item") < F.col("y.item")) & (F.col("x.component") != F.col("y.component"))
    if also is not None:
        match = match & also
    rest = x.join(y, match).select(F.col("x.item").alias("a"), F.col("y.item").alias("b")).distinct()
    more = steps.write(verify(rest))
    steps.drop(hubs, met, links, left)
    found = more.count()
    if not found:
        return label
    # what the first pairs connect is known: one link per item stands for it
    known_links = label.select(F.col("item").alias("a"), F.col("component").alias("b"))
    return steps.write(components(known_links.union(more), steps, n + found), n)
