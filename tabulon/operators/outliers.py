"""Isolation-forest scores: every tree is grown in its own task from its own small sample, all rows are scored in one scan."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import durable
from .quantiles import exact_quantiles

# Fixed value: Euler's constant, used in the mean depth of a random search tree.
EULER = 0.5772156649


def mean_depth(n: int) -> float:
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def grow_tree(rows: np.ndarray, limit: int, rng: np.random.Generator) -> np.ndarray:
    """Random cuts as a table of nodes: column, cut, left, right, path length at a leaf (column -1)."""
    nodes = [None]
    todo = [(0, rows, 0)]
    while todo:
        at, part, depth = todo.pop()
        low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(1), np.zeros(1))
        usable = np.flatnonzero(low < high)
        if depth >= limit or len(part) <= 1 or not len(usable):
            nodes[at] = (-1, 0.0, at, at, depth + mean_depth(len(part)))
            continue
        c = int(rng.choice(usable))
        cut = float(rng.uniform(low[c], high[c]))
        nodes[at] = (c, cut, len(nodes), len(nodes) + 1, 0.0)
        nodes += [None, None]
        todo.append((nodes[at][2], part[part[:, c] < cut], depth + 1))
        todo.append((nodes[at][3], part[part[:, c] >= cut], depth + 1))
    return np.array(nodes, dtype=float)


def tree_samples(df: DataFrame, key: str, columns: list[str], trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, h, key, columns): the ``sample`` rows of least hash for every tree, and few more.

    A row asks for each tree whether its hash is below a bound that about twice ``sample`` rows meet, so only rows that
    may be chosen are shuffled. A tree that got too few (next to impossible) makes the bound twice as large.
    """
    rows = df.select(F.col(key).alias("key"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    n = rows.count()
    share = min(1.0, 2.0 * sample / max(n, 1))
    while True:
        # 40 bits of the hash as a number from 0 to 1
        draw = lambda t: F.struct(t.alias("tree"), (F.pmod(F.xxhash64("key", t, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)).alias("h"))
        bound = F.lit(share)
        drawn = F.filter(F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), draw), lambda s: s["h"] < bound)  # noqa: B023
        picked = durable(rows.select("*", F.inline(drawn)))
        if share == 1.0 or picked.groupBy("tree").count().filter(F.col("count") >= sample).count() == trees:
            return picked
        share = min(1.0, 2 * share)


def isolation_forest(df: DataFrame, key: str, columns: list[str], trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """(tree, node, column, cut, left, right, length): one row per node; a leaf has column -1 and its path length.

    A tree's rows are sorted by hash and key, so it is the same under any partitioning.
    """
    width = len(columns)

    def grow(table: pd.DataFrame) -> pd.DataFrame:
        tree = int(table["tree"].iloc[0])
        rows = table.sort_values(["h", "key"])[[f"x{i}" for i in range(width)]].to_numpy(dtype=float)[:sample]
        limit = math.ceil(math.log2(max(len(rows), 2)))
        nodes = grow_tree(rows, limit, np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["column", "cut", "left", "right", "length"])
        return out.assign(tree=tree, node=range(len(out)))[["tree", "node", "column", "cut", "left", "right", "length"]]

    picked = tree_samples(df, key, columns, trees, sample, seed)
    kind = "tree int, node int, column int, cut double, left int, right int, length double"
    return picked.groupBy("tree").applyInPandas(grow, kind)


def isolation_scores(df: DataFrame, key: str, columns: list[str], trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """Adds ``anomaly`` in (0, 1]. The driver sees the node table, at most trees * (2 * sample - 1) rows whatever the table size."""
    values = [F.col(c).cast("double").alias(c) for c in columns]
    found = isolation_forest(df, key, columns, trees, sample, seed).toPandas().sort_values(["tree", "node"])
    forest = [part[["column", "cut", "left", "right", "length"]].to_numpy(dtype=float) for _, part in found.groupby("tree")]
    if not forest:
        return df.withColumn("anomaly", F.lit(None).cast("double"))
    size = min(sample, df.count())
    limit = math.ceil(math.log2(max(size, 2)))
    scale = mean_depth(max(size, 2))

    @F.pandas_udf(T.DoubleType())
    def score(row: pd.DataFrame) -> pd.Series:
        x = row.to_numpy(dtype=float)
        every = np.arange(len(x))
        total = np.zeros(len(x))
        for tree in forest:
            at = np.zeros(len(x), dtype=int)
            for _ in range(limit):
                c = tree[at, 0].astype(int)
                right = x[every, np.maximum(c, 0)] >= tree[at, 1]
                at = np.where(c < 0, at, np.where(right, tree[at, 3], tree[at, 2]).astype(int))
            total += tree[at, 4]
        return pd.Series(2.0 ** (-total / len(forest) / scale))

    return df.withColumn("anomaly", score(F.struct(*values)))


def isolation_outliers(df: DataFrame, key: str, columns: list[str], share: float = 0.05, **settings) -> DataFrame:
    """Adds ``outlier``: the rows whose score is above the (1 - share) quantile."""
    scored = isolation_scores(df, key, columns, **settings)
    cut = exact_quantiles(scored, "anomaly", {"q": 1 - share}).scalar()
    return scored.withColumn("outlier", F.col("anomaly") > cut)
