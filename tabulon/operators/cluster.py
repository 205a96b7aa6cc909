"""Clustering: k-means tables, agreement with labels, density clusters on a grid."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import safe_divide
from ..sources.scratch import durable
from .ordered import Ordered, ordered


def as_vectors(df: DataFrame, array: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.transform(array, lambda x: x.cast("double"))))


def best_kmeans(df: DataFrame, k: int, seeds=(1, 2, 3), max_iter: int = 20, tol: float = 1e-4):
    """The model with the lowest cost over several starts."""
    models = [KMeans(k=k, seed=s, maxIter=max_iter, tol=tol, featuresCol="features").fit(df) for s in seeds]
    return min(models, key=lambda m: m.summary.trainingCost)


def elbow(df: DataFrame, ks: list[int], seeds=(1, 2)) -> list[tuple[int, float]]:
    return [(k, float(best_kmeans(df, k, seeds).summary.trainingCost)) for k in ks]


def squared_distance(a: Column, center: list[float]) -> Column:
    c = F.array(*[F.lit(float(x)) for x in center])
    return F.aggregate(F.zip_with(a, c, lambda x, y: F.pow(x.cast("double") - y, 2)), F.lit(0.0), lambda s, x: s + x)


def assign(df: DataFrame, array: str, centers: list[list[float]], name: str = "cluster") -> DataFrame:
    """The nearest centre of every row, the first on a tie."""
    options = F.array(*[F.struct(squared_distance(F.col(array), c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)])
    return df.withColumn(name, F.array_min(options)["i"])


def new_centers(df: DataFrame, array: str, cluster: str) -> DataFrame:
    """(cluster, position, mean): the mean vector of every cluster as rows."""
    cells = df.select(cluster, F.posexplode(array).alias("position", "x"))
    return cells.groupBy(cluster, "position").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def _distance_sums(a: np.ndarray, b: np.ndarray, tile: int = 1024) -> np.ndarray:
    """Of every row of ``a`` the sum of its Euclidean distances to the rows of ``b``, by matrix products of tiles.

    Squared lengths less the product lose digits where points lie close for their lengths; such pairs are measured by their differences.
    """
    out = np.zeros(len(a))
    long_a, long_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
    for i in range(0, len(a), tile):
        for j in range(0, len(b), tile):
            x, y = a[i : i + tile], b[j : j + tile]
            both = long_a[i : i + tile, None] + long_b[None, j : j + tile]
            square = x @ y.T
            square *= -2
            square += both
            both *= 1e-3
            left, right = np.nonzero(~(square >= both))
            for k in range(0, len(left), 8 * tile):
                m, n = left[k : k + 8 * tile], right[k : k + 8 * tile]
                square[m, n] = ((x[m] - y[n]) ** 2).sum(axis=1)
            out[i : i + tile] += np.sqrt(square, out=square).sum(axis=1)
    return out


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """(begin, stop) of the runs of rows that are equal in all columns."""
    new = np.any([np.diff(c, prepend=c[:1] - 1) != 0 for c in columns], axis=0)
    stops = np.append(np.flatnonzero(new), len(new))
    return list(zip(stops[:-1].tolist(), stops[1:].tolist()))


def silhouettes(df: DataFrame, key: str, array: str, cluster: str, block: int = 16384) -> DataFrame:
    """(key, cluster, a, b, silhouette) by Euclidean distance: mean distance to the other points of the own cluster, least mean distance
    to another cluster, and ``(b - a) / max(a, b)``; 0 for a point alone in its cluster, null where there is one cluster only.

    A cluster's mean distance is at least the distance to its centre and at most the root of that squared plus its mean squared
    radius; clusters whose lower bound is above the least upper bound are left out. The others are measured exactly: a task holds up to
    about ``block`` points and the points of a cluster pass by, an Arrow batch at a time; only sums per point leave it. The driver holds the centres.
    """
    points = durable(df.select(F.col(key).alias("key"), F.transform(array, lambda v: v.cast("double")).alias("x"), F.col(cluster).alias("c")))
    means = points.select("c", F.posexplode("x").alias("at", "v")).groupBy("c", "at").agg(F.avg("v").alias("m"), F.var_pop("v").alias("v"), F.count("v").alias("n"))
    found: dict = {}
    for r in means.orderBy("c", "at").collect():
        found.setdefault(r.c, []).append((r.m, r.v, r.n))
    names = list(found)
    if not names:
        return df.select(key, F.col(cluster).alias("cluster"), *[F.lit(None).cast("double").alias(n) for n in ("a", "b", "silhouette")]).limit(0)
    centers = np.array([[m for m, _, _ in found[c]] for c in names])
    radius = np.array([sum(v for _, v, _ in found[c]) for c in names])
    sizes = [found[c][0][2] for c in names]
    place = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(c), F.lit(i))])

    @F.pandas_udf("array<int>")
    def asked(x: pd.Series, own: pd.Series) -> pd.Series:
        rows, mine = np.stack(list(x)), own.to_numpy()
        square = np.stack([((rows - c) ** 2).sum(axis=1) for c in centers], axis=1)
        high = np.sqrt(square + radius)
        high[np.arange(len(rows)), mine] = np.inf
        near = np.sqrt(square) * (1 - 1e-9) <= high.min(axis=1, keepdims=True) * (1 + 1e-9)
        near[np.arange(len(rows)), mine] = True
        return pd.Series([np.flatnonzero(n).astype(np.int32) for n in near])

    # the points that ask for a cluster are dealt to parts: as many as blocks, and more while that gives the cores work
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-sum(sizes) // block), min(-(-sum(sizes) // 256), -(-4 * cores // len(names))))
    numbered = points.withColumn("i", place[F.col("c")])
    there = numbered.select("i", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("side"), F.lit(None).cast(points.schema["key"].dataType).alias("key"), "x")
    here = numbered.select("key", "x", F.explode(asked("x", "i")).alias("i"))
    here = here.select("i", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("side"), "key", "x")
    kind = T.StructType([T.StructField("keys", points.schema["key"].dataType), T.StructField("i", T.IntegerType()), T.StructField("s", T.DoubleType())])

    def work(batches):
        group, mine, asking, sums = None, [], [], None

        def done():
            if asking:
                yield pa.record_batch([pa.concat_arrays(asking), pa.array(np.full(len(sums), group[0], np.int32)), pa.array(sums)], names=kind.names)

        for batch in batches:
            i, part, side = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for lo, hi in _runs(i, part, side):
                if group != (i[lo], part[lo]):
                    yield from done()
                    group, mine, asking, sums = (i[lo], part[lo]), [], [], np.zeros(0)
                center = centers[group[0]]
                x = batch.column(4).slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False).reshape(hi - lo, -1) - center
                if side[lo] == 0:
                    mine.append(x)
                    asking.append(batch.column(3).slice(lo, hi - lo))
                    sums = np.zeros(sum(map(len, mine)))
                elif asking:
                    mine = [np.concatenate(mine)] if len(mine) > 1 else mine
                    sums += _distance_sums(mine[0], x)
        yield from done()

    met = here.union(there).repartition(parts * len(names), "i", "part").sortWithinPartitions("i", "part", "side")
    met = met.mapInArrow(work, kind)
    total = met.groupBy("keys", "i").agg(F.sum("s").alias("s"))
    both = total.join(numbered.select(F.col("key").alias("keys"), "c", F.col("i").alias("own")), "keys")
    count = F.element_at(F.array(*[F.lit(n) for n in sizes]), F.col("i") + 1)
    mine = F.col("i") == F.col("own")
    done = both.groupBy("keys", "c").agg(
        F.max(F.when(mine & (count > 1), F.col("s") / (count - 1))).alias("a"), F.min(F.when(~mine, F.col("s") / count)).alias("b")
    )
    score = F.when(F.col("b").isNull(), None).when(F.col("a").isNull(), 0.0).otherwise(safe_divide(F.col("b") - F.col("a"), F.greatest("a", "b")))
    return done.select(F.col("keys").alias(key), F.col("c").alias("cluster"), "a", "b", F.when(F.greatest("a", "b") == 0, 0.0).otherwise(score).alias("silhouette"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two labelings from their contingency table, corrected for chance."""
    cells = df.groupBy(a, b).agg(F.count("*").alias("n"))
    pairs = lambda n: n * (n - 1) / 2
    both = cells.agg(F.sum(pairs(F.col("n")))).scalar()
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n")))).scalar()
    cols = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n")))).scalar()
    total = cells.agg(F.sum("n").alias("n")).select(
        pairs(F.col("n")).alias("all"), both.alias("both"), rows.alias("rows"), cols.alias("cols")
    )
    expected = F.col("rows") * F.col("cols") / F.col("all")
    best = (F.col("rows") + F.col("cols")) / 2
    return total.select(safe_divide(F.col("both") - expected, best - expected).alias("adjusted_rand"))


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that can be reached, by rounds of joins with label shortcuts."""
    edges = durable(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = durable(nodes.select("node", F.col("node").alias("component")))
    for _ in range(rounds):
        near = edges.join(state, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("_near"))
        step = state.join(near, "node", "left").select("node", "component", F.least("component", "_near").alias("_new"))
        jump = state.select(F.col("node").alias("_new"), F.col("component").alias("_jump"))
        moved = step.join(jump, "_new", "left").select(
            "node", F.least("_new", "_jump").alias("component"), (F.least("_new", "_jump") != F.col("component")).alias("_moved")
        )
        moved = durable(moved)
        state = moved.select("node", "component")
        if moved.filter("_moved").limit(1).count() == 0:
            return state
    raise RuntimeError("components did not settle")


def density_clusters(df: DataFrame, key: str, dims: list[str], eps: float, min_samples: int, rounds: int = 40) -> DataFrame:
    """(key, cluster) with -1 for noise; clusters of points with at least ``min_samples`` points within ``eps``.

    Points fall in grid cells so small that all points of a cell are neighbours. A cell with enough
    points needs no distances at all, and a cell with few points adds few candidates, so no group is
    paired with itself. Two cells of core points are linked when some pair is within ``eps``: boxes
    around their points decide this, and only undecided boxes are cut again. Copies of a point count
    as one with a weight. Meant for two or three dimensions.
    """
    d = len(dims)
    side = eps / math.sqrt(d)
    points = df.select(key, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(dims)])
    xs = [f"x{i}" for i in range(d)]
    distinct = points.groupBy(*xs).agg(F.count(F.lit(1)).alias("w"))
    cell = F.array(*[F.floor(F.col(x) / side) for x in xs])
    distinct = durable(distinct.withColumn("cell", cell))
    weights = distinct.groupBy("cell").agg(F.sum("w").alias("cw"))

    reach = math.ceil(math.sqrt(d))
    gap = lambda o: sum(max(abs(v) - 1, 0) ** 2 for v in o) * side * side
    offsets = [o for o in itertools.product(range(-reach, reach + 1), repeat=d) if any(o) and gap(o) <= eps * eps]
    shifts = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in o]) for o in offsets])
    shifted = lambda c: F.explode(F.transform(shifts, lambda o: F.zip_with(c, o, lambda a, b: a + b)))

    def near(a: str, b: str) -> Column:
        return sum((F.pow(F.col(f"{a}{x}") - F.col(f"{b}{x}"), 2) for x in xs), F.lit(0.0)) <= eps * eps

    # Core points: cells with enough points, and points of thin cells with enough points around them.
    sized = distinct.join(weights, "cell")
    dense = sized.filter(F.col("cw") >= min_samples).select("cell", *xs)
    thin = sized.filter(F.col("cw") < min_samples)
    probe = thin.select("cell", "cw", *[F.col(x).alias(f"p{x}") for x in xs]).withColumn("other", shifted(F.col("cell")))
    there = distinct.select(F.col("cell").alias("other"), "w", *[F.col(x).alias(f"q{x}") for x in xs])
    around = probe.join(there, "other").filter(near("p", "q")).groupBy("cell", "cw", *[f"p{x}" for x in xs]).agg(F.sum("w").alias("out"))
    core_thin = around.filter(F.col("cw") + F.col("out") >= min_samples).select("cell", *[F.col(f"p{x}").alias(x) for x in xs])
    core = durable(dense.union(core_thin))

    # Linked cells: boxes around the core points of both cells; an undecided pair of boxes is cut in halves.
    cells = core.select("cell").distinct()
    pairs = cells.withColumn("other", shifted(F.col("cell"))).join(cells.select(F.col("cell").alias("other")), "other")
    halves = lambda c: F.transform(c, lambda v: F.floor(v / 2))
    open_pairs = pairs.filter(F.col("cell") < F.col("other")).select("cell", "other", halves(F.col("cell")).alias("pa"), halves(F.col("other")).alias("pb"))
    open_pairs = durable(open_pairs)
    linked = None
    refine = 1
    for _ in range(rounds):
        sub = F.array(*[F.floor(F.col(x) / (side / refine)) for x in xs])
        boxes = core.groupBy("cell", sub.alias("sub")).agg(
            *[F.min(x).alias(f"lo{x}") for x in xs], *[F.max(x).alias(f"hi{x}") for x in xs]
        )
        corner = lambda side_name: [F.col(f"{e}{x}").alias(f"{side_name}{e}{x}") for e in ("lo", "hi") for x in xs]
        left = boxes.select("cell", F.col("sub").alias("sa"), halves(F.col("sub")).alias("pa"), *corner("a"))
        right = boxes.select(F.col("cell").alias("other"), F.col("sub").alias("sb"), halves(F.col("sub")).alias("pb"), *corner("b"))
        both = open_pairs.join(left, ["cell", "pa"]).join(right, ["other", "pb"])
        apart = sum(
            (F.pow(F.greatest(F.col(f"alo{x}") - F.col(f"bhi{x}"), F.col(f"blo{x}") - F.col(f"ahi{x}"), F.lit(0.0)), 2) for x in xs), F.lit(0.0)
        )
        across = sum(
            (F.pow(F.greatest(F.col(f"ahi{x}") - F.col(f"blo{x}"), F.col(f"bhi{x}") - F.col(f"alo{x}")), 2) for x in xs), F.lit(0.0)
        )
        judged = durable(both.select("cell", "other", "sa", "sb", (across <= eps * eps).alias("yes"), (apart <= eps * eps).alias("maybe")).filter("maybe"))
        found = judged.filter("yes").select("cell", "other").distinct()
        linked = found if linked is None else linked.union(found)
        open_pairs = judged.filter("not yes").join(found, ["cell", "other"], "left_anti").select(
            "cell", "other", F.col("sa").alias("pa"), F.col("sb").alias("pb")
        )
        open_pairs = durable(open_pairs)
        if open_pairs.limit(1).count() == 0:
            break
        refine *= 2
    else:
        raise RuntimeError("cells stayed undecided")

    name = lambda c: F.concat_ws(",", c)
    groups = components(
        cells.select(name(F.col("cell")).alias("node")), linked.select(name(F.col("cell")).alias("a"), name(F.col("other")).alias("b"))
    )
    core = core.withColumn("node", name(F.col("cell"))).join(groups, "node").select("cell", *xs, "component")

    # Border points take the first cluster with a core point within reach, in their own cell or around.
    known = core.select(*xs, "component")
    rest = distinct.select("cell", *xs).join(core.select(*xs), xs, "left_anti")
    all_shifts = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in o]) for o in [(0,) * d, *offsets]])
    looking = rest.select("cell", *[F.col(x).alias(f"p{x}") for x in xs]).withColumn(
        "other", F.explode(F.transform(all_shifts, lambda o: F.zip_with(F.col("cell"), o, lambda a, b: a + b)))
    )
    seen = core.select(F.col("cell").alias("other"), "component", *[F.col(x).alias(f"q{x}") for x in xs])
    border = (
        looking.join(seen, "other")
        .filter(near("p", "q"))
        .groupBy(*[F.col(f"p{x}").alias(x) for x in xs])
        .agg(F.min("component").alias("component"))
    )
    labels = known.union(border.select(*xs, "component"))
    # Cluster numbers: components in order; there are at most as many as cells with core points.
    numbers = labels.select("component").distinct()
    ranked = ordered(numbers.withColumn("_h", F.xxhash64("component")), Ordered(order="_h", row_number="_rn"))
    named = labels.join(ranked.select("component", (F.col("_rn") - 1).alias("cluster")), "component").select(*xs, "cluster")
    return points.join(named, xs, "left").select(key, F.coalesce("cluster", F.lit(-1)).alias("cluster"))
