"""The perceptron rule on a table: mistake-driven passes in tasks, mixed into one weight vector per epoch.

Rows are dealt into parts by a hash and each part is written once as a block of numbers in hash order. In an epoch every
part starts from the shared weights and corrects them at each of its mistakes, row by row; the mean over the parts is
the next shared vector. On separable rows the mixed vector makes no mistakes after finitely many epochs. With one
part this is the textbook loop. Nothing is shuffled after the blocks are written but a vector per part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import durable
from .ordered import stable_hash

ROWS_PER_PART = 50_000


@dataclass
class Perceptron:
    """Weights, bias, and the mistakes of every epoch over all parts."""

    columns: list[str]
    weights: list[float]
    bias: float
    mistakes: list[int]

    def score(self) -> Column:
        total = F.lit(self.bias)
        for c, w in zip(self.columns, self.weights):
            total = total + F.col(c).cast("double") * F.lit(w)
        return total

    def predict(self) -> Column:
        return (self.score() >= 0).cast("int")


def _blocks(df: DataFrame, key: str, columns: list[str], label: str, parts: int, seed: int) -> DataFrame:
    """(part, x, y): every part as bytes, rows in hash order, a one behind the columns of each row for the bias."""
    x = F.array(*[F.col(c).cast("double") for c in columns], F.lit(1.0))
    rows = df.select(key, x.alias("x"), F.when(F.col(label) > 0, 1.0).otherwise(-1.0).alias("y"), stable_hash(key, seed=seed).alias("h"))
    rows = rows.withColumn("part", F.pmod(F.col("h"), F.lit(parts)).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), (key, "ascending")])
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("float64")
        y = table["y"].to_numpy().astype("float64")
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "x": [x.tobytes()], "y": [y.tobytes()]})

    return durable(rows.groupBy("part").applyInArrow(pack, "part int, x binary, y binary"))


def fit_perceptron(
    df: DataFrame, key: str, columns: list[str], label: str, rate: float = 1.0, epochs: int = 25, parts: int | None = None, seed: int = 42
) -> Perceptron:
    """Weights after at most ``epochs`` passes, fewer if a pass makes no mistake. Rows with a null or infinite column are left out;
    without rows all weights are 0.

    The driver sees one vector per epoch. ``parts`` follows from the number of rows unless it is given.
    """
    usable = df
    for c in columns:
        x = F.col(c).cast("double")
        usable = usable.filter(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if parts is None:
        parts = max(1, math.ceil(usable.count() / ROWS_PER_PART))
    blocks = _blocks(usable, key, columns, label, parts, seed)
    width = len(columns) + 1
    shared, history = np.zeros(width), []

    for _ in range(epochs):
        begin = shared.copy()

        def epoch(batches, begin=begin):
            for batch in batches:
                out = []
                for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    x, y = np.frombuffer(x).reshape(-1, width), np.frombuffer(y)
                    w, wrong, at = begin.copy(), 0, 0
                    while at < len(y):  # margins of the next rows at once, as far as the next mistake
                        some = y[at : at + 512] * (x[at : at + 512] @ w) <= 0
                        if not some.any():
                            at += 512
                            continue
                        at += int(some.argmax())
                        w = w + rate * y[at] * x[at]
                        wrong, at = wrong + 1, at + 1
                    out.append((w.tolist(), wrong))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w for w, _ in out], pa.list_(pa.float64())), pa.array([n for _, n in out], pa.int64())], names=["w", "wrong"]
                )

        told = blocks.select("x", "y").mapInArrow(epoch, "w array<double>, wrong long")
        mixed = told.select("wrong", F.posexplode("w").alias("at", "v")).groupBy("at").agg(F.avg("v").alias("v"), F.sum("wrong").alias("wrong")).collect()
        if not mixed:
            break
        for r in mixed:
            shared[r.at] = r.v
        history.append(int(mixed[0].wrong))
        if history[-1] == 0:
            break
    return Perceptron(list(columns), [float(v) for v in shared[:-1]], float(shared[-1]), history)
