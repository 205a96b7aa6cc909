"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

A rotation of the principal axes is learned so that the signs of the rotated vectors lose as little as possible: a
balanced binary code. Codes are cut into ``TABLES`` substrings, each with a table of its own, and every code looks
up each of its substrings and all that differ from it in one bit. Codes that meet and differ in at most
``RADIUS`` bits altogether are compared by their original vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .steps import Steps

BITS = 64
TABLES = 5
RADIUS = 20
SAMPLE = 16384
COSINE = 0.93


def learn_rotation(sample: np.ndarray, bits: int = BITS, rounds: int = 50, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection dims x bits) from unit vectors. Fewer dimensions than bits: several rotations side by side."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(0)
    _, axes = np.linalg.eigh(np.cov((sample - mean).T).reshape(sample.shape[1], -1))
    axes, parts = axes[:, ::-1][:, :bits], []
    while sum(p.shape[1] for p in parts) < bits:
        flat = (sample - mean) @ axes
        turn = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))[0]
        for _ in range(rounds):  # nearest corners for the rotation, then the nearest rotation for the corners
            u, _, v = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        parts.append(axes @ turn)
    return mean, np.concatenate(parts, 1)[:, :bits]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows as unit vectors of ``dims`` numbers; other lengths are cut or filled up, which only codes see."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    if (sizes == dims).all():
        out = flat.reshape(-1, dims)
    else:
        out = np.zeros((len(column), dims))
        owner = np.repeat(np.arange(len(column)), sizes)
        at = np.arange(len(flat)) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        keep = at < dims
        out[owner[keep], at[keep]] = flat[keep]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def unit_sample(column: pa.ChunkedArray) -> np.ndarray:
    """The rows of the commonest length as unit vectors. They are made chunk by chunk, so little is held beside the column and the result."""
    sizes = [np.diff(c.offsets.to_numpy()) for c in column.chunks]
    if not len(column):
        return np.zeros((0, 0))
    dims = int(np.bincount(np.concatenate(sizes)).argmax())
    return np.concatenate([_matrix(c.filter(pa.array(n == dims)), dims) for c, n in zip(column.chunks, sizes)])


def codes(vectors: DataFrame, mean: np.ndarray, projection: np.ndarray) -> DataFrame:
    """(item, label, code): the sign bits of every row of ``vectors`` (item, label, embedding) as a long."""

    def work(batches):
        weight = np.uint64(1) << np.arange(projection.shape[1], dtype=np.uint64)
        for batch in batches:
            signs = (_matrix(batch.column(2), len(mean)) - mean) @ projection >= 0
            packed = (signs * weight).sum(1, dtype=np.uint64).view(np.int64)
            yield pa.record_batch({"item": batch.column(0), "label": batch.column(1), "code": pa.array(packed)})

    kind = vectors.select("item", "label").schema.add("code", "long")
    return vectors.select("item", "label", "embedding").mapInArrow(work, kind)


def _dot(x: str | Column, y: str | Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, radius: int = RADIUS, sample: int = SAMPLE, bits: int = BITS
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Vectors link if their labels and lengths are equal and their cosine is ``cosine`` or more. A null or empty
    vector, one that is zero or holds null or non-finite numbers, a null label and a null vec_id link with nothing. Rows equal in id,
    label and vector are one vector; equal vectors link whatever their codes. The rotation is
    learned on at most ``sample`` vectors, the smallest by a hash of the id; all vectors are coded and searched.
    """
    steps = Steps(vectors.sparkSession, "vectors", measured=True)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    sound = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    sound = sound.withColumn("square", _dot("embedding", "embedding")).filter("square > 0 and square < double('infinity')").distinct()
    groups = sound.groupBy("label", "embedding").agg(F.min("vec_id").alias("item"), F.count("*").alias("copies"), F.first("square").alias("square"))
    items = steps.write(groups.withColumn("vector", F.xxhash64("label", "embedding")))
    chosen = unit_sample(items.orderBy(F.xxhash64("item"), "item").limit(sample).select("embedding").toArrow()["embedding"])
    if not len(chosen):
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    fitted = learn_rotation(chosen, bits)
    coded = steps.write(codes(items, *fitted))

    cuts = np.linspace(0, bits, tables + 1).round().astype(int)
    masks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(cuts, cuts[1:])]
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    part = lambda t: F.col("code").bitwiseAND(F.lit(masks[t]))
    own = [F.struct(F.lit(t).alias("t"), part(t).alias("sub")) for t in range(tables)]
    flips = [
        F.struct(F.lit(t).alias("t"), part(t).bitwiseXOR(F.lit((1 << b) - (1 << 64) if b == 63 else 1 << b)).alias("sub"))
        for t in range(tables)
        for b in range(cuts[t], cuts[t + 1])
    ]
    index = coded.select("label", "item", "code", F.explode(F.array(*own)).alias("at")).alias("i")
    probe = coded.select("label", "item", "code", F.explode(F.array(*own, *flips)).alias("at")).alias("p")
    apart = F.col("i.code").bitwiseXOR(F.col("p.code"))
    met_before = F.lit(False)  # a pair counts in the first table in which it meets
    for t in range(tables - 1):
        met_before = met_before | ((F.col("i.at.t") > t) & (F.bit_count(apart.bitwiseAND(F.lit(masks[t]))) <= 1))
    match = (F.col("i.label") == F.col("p.label")) & (F.col("i.at") == F.col("p.at")) & (F.col("i.item") < F.col("p.item"))
    found = index.join(probe, match & (F.bit_count(apart) <= radius) & ~met_before).select(F.col("i.item").alias("a"), F.col("p.item").alias("b"))
    side = lambda n, v, s: items.select(F.col("item").alias(n), F.col("embedding").alias(v), F.col("square").alias(s))
    both = found.join(side("a", "x", "xx"), "a").join(side("b", "y", "yy"), "b").filter(F.size("x") == F.size("y"))
    links = steps.write(both.filter(_dot("x", "y") / (F.sqrt("xx") * F.sqrt("yy")) >= cosine).select("a", "b"))

    group = steps.write(components(links, steps))
    ends = links.union(links.select("b", "a"))
    # the result is planned by the caller's settings: joins with sides as small in files as links and groups say that neither is broadcast
    count = ends.hint("merge").join(items.select(F.col("item").alias("b"), "copies"), "b").groupBy(F.col("a").alias("item")).agg(F.sum("copies").alias("others"))
    known = items.select("item", "label", "embedding", "vector", "copies").join(count, "item", "left").join(group.hint("merge"), "item", "left")
    known = known.select(
        "label", "embedding", "vector", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "item").alias("component_id")
    )
    rows = rows.withColumn("vector", F.xxhash64("label", "embedding"))
    match = (rows["vector"] == known["vector"]) & (rows["label"] == known["label"]) & (rows["embedding"] == known["embedding"]) & rows["vec_id"].isNotNull()
    out = rows.join(known, match, "left").select(rows["vec_id"], known["n_links"], known["component_id"])
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
