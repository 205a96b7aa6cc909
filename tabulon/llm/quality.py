"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded: hashed character
trigrams and counts of character classes and repetitions, then one dense layer. Gated attention
weighs the passages of a document, and the weighted mean gives the score. Only documents carry labels;
the attention weights are learned from them. The model is fitted on a bounded sample of labelled rows,
scoring covers every passage of every text inside the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .steps import Steps
from .words import LOWER, PIECE, column_bytes, mix, ranges, word_hashes

PASSAGE = 64
TRIGRAMS = 256
SAMPLE_PER_CLASS = 4000
SAMPLE_PASSAGES = 64
THRESHOLD = 0.3

_CLASSES = np.full(256, 6, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 blank, 4 line end, 5 plain punctuation, 6 symbol, 7 beyond ASCII
for _byte in range(256):
    _char = chr(_byte)
    if _byte > 127:
        _CLASSES[_byte] = 7
    elif _char.islower():
        _CLASSES[_byte] = 0
    elif _char.isupper():
        _CLASSES[_byte] = 1
    elif _char.isdigit():
        _CLASSES[_byte] = 2
    elif _char in " \t\x0b\x0c":
        _CLASSES[_byte] = 3
    elif _char in "\r\n":
        _CLASSES[_byte] = 4
    elif _char in ".,;:'\"()-?":
        _CLASSES[_byte] = 5
WIDTH = TRIGRAMS + 8 + 6


def _repeats(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """1 where the value stood earlier in the same owner."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    out = np.zeros(len(values), np.float32)
    out[order[1:]] = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
    return out


def passages(data: np.ndarray, offsets: np.ndarray, slab: int = 4096):
    """(bounds, iterator of feature blocks). A text without words has one passage of zeros."""
    start, end, words = word_hashes(data, offsets, lower=True)
    per_text = np.searchsorted(start, offsets)
    counts = np.diff(per_text)
    text = np.repeat(np.arange(len(counts)), counts)
    inner = (np.arange(len(words)) - per_text[:-1][text]) // PASSAGE
    n_passages = np.maximum(1, -(-counts // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(n_passages)])
    owner = bounds[:-1][text] + inner
    pair = words.copy()
    pair[1:] = mix(words[1:] * np.uint64(3) + words[:-1])
    opens = per_text[:-1][counts > 0]  # the word before belongs to another text
    pair[opens] = words[opens]
    seen = _repeats(pair, text)
    again = _repeats(words, owner)
    same = np.zeros(len(words), np.float32)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    length = (end - start).astype(np.float32)

    def blocks():
        for lo in range(0, int(bounds[-1]), slab):
            hi = min(lo + slab, int(bounds[-1]))
            a, b = np.searchsorted(owner, [lo, hi])
            n = hi - lo
            out = np.zeros((n, WIDTH), np.float32)
            if b > a:
                own = owner[a:b] - lo
                total = np.bincount(own, minlength=n).astype(np.float32)
                piece = data[start[a] : end[b - 1]]
                first = np.concatenate([[True], own[1:] != own[:-1]])
                spans = np.diff(np.append(start[a:b][first], end[b - 1]))
                place = np.repeat(own[first], spans)
                low = LOWER[piece].astype(np.uint32)
                code = np.zeros(len(piece), np.int64)
                # a passage ends with its last word: what follows up to the next one, or stands in another text, does not count
                stop = np.repeat(end[a:b][np.concatenate([first[1:], [True]])] - start[a], spans)
                inside, at = np.arange(len(piece)) < stop, np.arange(len(piece)) + 2 < stop
                if len(piece) > 2:
                    code[:-2] = (low[:-2] * np.uint32(2654435761) + low[1:-1] * np.uint32(2246822519) + low[2:] * np.uint32(3266489917)) >> np.uint32(24)
                grams = np.bincount((place * TRIGRAMS + code)[at], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
                kinds = np.bincount((place * 8 + _CLASSES[piece])[inside], minlength=n * 8).reshape(n, 8)
                size = np.maximum(1, kinds.sum(1, keepdims=True)).astype(np.float32)
                out[:, :TRIGRAMS] = np.sqrt(grams / size)
                out[:, TRIGRAMS : TRIGRAMS + 8] = np.sqrt(kinds / size)
                most = np.maximum(1, total)
                mean = lambda x: np.bincount(own, x[a:b], n).astype(np.float32) / most
                out[:, TRIGRAMS + 8 :] = np.stack([mean(again), mean(same), mean(seen), mean(length) / 10, np.sqrt(mean(length * length)) / 10, np.log1p(total) / 4], 1)
            yield out

    return bounds, blocks()


@dataclass
class Model:
    """Weights of encoder (w, b), gated attention (v, u, a) and output (c, d)."""

    w: np.ndarray
    b: np.ndarray
    v: np.ndarray
    u: np.ndarray
    a: np.ndarray
    c: np.ndarray
    d: np.ndarray

    def encode(self, x):
        h = np.tanh(x @ self.w + self.b)
        return h, (np.tanh(h @ self.v) / (1 + np.exp(-(h @ self.u)))) @ self.a

    def scores(self, h, e, bounds):
        z = _pool(h, e, bounds)[0]
        return 1 / (1 + np.exp(-np.clip(z @ self.c + self.d[0], -30, 30)))


def _pool(h, e, bounds):
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    weight = np.exp(e - np.maximum.reduceat(e, bounds[:-1])[owner])
    weight = weight / np.add.reduceat(weight, bounds[:-1])[owner]
    return np.add.reduceat(h * weight[:, None], bounds[:-1]), weight, owner


def _gradients(m: Model, x, bounds, y, weight):
    h = np.tanh(x @ m.w + m.b)
    t, g = np.tanh(h @ m.v), 1 / (1 + np.exp(-(h @ m.u)))
    z, a, owner = _pool(h, (t * g) @ m.a, bounds)
    p = 1 / (1 + np.exp(-np.clip(z @ m.c + m.d[0], -30, 30)))
    ds = (weight * (p - y) / weight.sum()).astype(np.float32)
    dz = (ds[:, None] * m.c)[owner]
    da = (h * dz).sum(1)
    de = a * (da - np.add.reduceat(a * da, bounds[:-1])[owner])
    dtg = de[:, None] * m.a
    dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
    dh = (a[:, None] * dz + dt @ m.v.T + dg @ m.u.T) * (1 - h * h)
    return {"w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de, "c": z.T @ ds, "d": np.array([ds.sum()])}


def fit_model(x: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int = 32, gate: int = 16, epochs: int = 30, seed: int = 7) -> Model:
    """Adam on the weighted log loss of the documents. ``x`` holds the passages of the sample, a bounded matrix."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    m = Model(draw(x.shape[1], hidden) * 4, np.zeros(hidden, np.float32), draw(hidden, gate), draw(hidden, gate), draw(gate), draw(hidden), np.zeros(1, np.float32))
    first = {k: np.zeros_like(v) for k, v in vars(m).items()}
    second, step = {k: np.zeros_like(v) for k, v in vars(m).items()}, 0
    for epoch in range(epochs):
        order, rate = rng.permutation(len(y)), 0.01 * (0.5 if epoch > epochs * 2 // 3 else 1)
        for lo in range(0, len(y), 128):
            pick = np.sort(order[lo : lo + 128])
            sizes = bounds[pick + 1] - bounds[pick]
            rows = np.repeat(bounds[pick] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
            grads, step = _gradients(m, x[rows].astype(np.float32), np.concatenate([[0], np.cumsum(sizes)]), y[pick], weight[pick]), step + 1
            for k, grad in grads.items():
                grad = grad + 1e-4 * getattr(m, k)
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(m, k, (getattr(m, k) - rate * move).astype(np.float32))
    return m


def document_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, quality): one label per document, the majority of its rows, 1 on a tie; rows without one are left out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("doc_id is not null and quality is not null")
    return known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))


def held_out(doc_id) -> F.Column:
    """True where crc32 of the id as text leaves remainder 0 by 5: rows whose labels are never learned. A null id: false."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, most_passages: int = SAMPLE_PASSAGES) -> Model | None:
    """Fit on at most ``per_class`` documents of each label, the smallest by a hash of the id.

    Of a sampled document at most ``most_passages`` passages, evenly spread, are learned from, which bounds
    what reaches the driver: 2 * per_class * most_passages rows of ``WIDTH`` numbers. Sample weights
    restore the shares of the labels. None if a label is missing.
    """
    steps = Steps(docs.sparkSession, "quality")
    known = steps.write(document_labels(labels).filter(~held_out("doc_id")))
    sizes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return None
    rank = F.xxhash64("doc_id", F.lit(17))
    parts = [known.filter(F.col("quality") == k).orderBy(rank, "doc_id").limit(per_class) for k in (0, 1)]
    chosen = steps.write(parts[0].union(parts[1]))

    def work(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for lo, hi in ranges(offsets, PIECE):
                base = offsets[lo]
                bounds, blocks = passages(data[base : offsets[hi]], offsets[lo : hi + 1] - base)
                take = [np.unique(np.linspace(a, b - 1, min(b - a, most_passages)).astype(np.int64)) for a, b in zip(bounds, bounds[1:])]
                wanted, at, kept = np.concatenate(take), 0, []
                for block in blocks:
                    here = wanted[(wanted >= at) & (wanted < at + len(block))] - at
                    kept.append(block[here])
                    at += len(block)
                rows, stops = np.concatenate(kept), np.concatenate([[0], np.cumsum([len(t) for t in take])])
                yield pa.record_batch(
                    {
                        "doc_id": batch.column(0).slice(lo, hi - lo),
                        "quality": batch.column(2).slice(lo, hi - lo),
                        "x": pa.array([rows[a:b].astype(np.float16).tobytes() for a, b in zip(stops, stops[1:])], pa.binary()),
                    }
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    rows = steps.write(texts.select("doc_id", "text", "quality").mapInArrow(work, "doc_id long, quality int, x binary"))
    # a doc_id that repeats in the documents stands for one sampled document
    rows = rows.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).orderBy("doc_id").toArrow()
    steps.drop(known, chosen)
    if not rows.num_rows:
        return None
    y = rows["quality"].to_numpy().astype(np.float32)
    weight = np.array([sizes[int(q)] / max(1, (y == q).sum()) for q in y], np.float32)
    # the sample stays as it came, once and in half precision; fitting widens a few documents at a time
    _, ends, values = rows["x"].combine_chunks().cast(pa.large_binary()).buffers()
    del rows
    bounds = np.frombuffer(ends, np.int64)[: len(y) + 1] // (2 * WIDTH)
    return fit_model(np.frombuffer(values, np.float16)[: bounds[-1] * WIDTH].reshape(-1, WIDTH), bounds, y, weight / weight.mean())


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` (with text) and score (0 to 1, six digits), predicted (1 if score >= threshold).

    Null and empty texts and texts without words are scored as one empty passage. Without a model every score is 0.5.
    Existing columns of these two names are replaced.
    """
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")

    def work(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(at))
            out = np.full(batch.num_rows, 0.5)
            for lo, hi in ranges(offsets, PIECE) if model else ():
                base = offsets[lo]
                bounds, blocks = passages(data[base : offsets[hi]], offsets[lo : hi + 1] - base)
                pairs = [model.encode(block) for block in blocks]
                out[lo:hi] = model.scores(np.concatenate([h for h, _ in pairs]), np.concatenate([e for _, e in pairs]), bounds)
            out = out.round(6)  # the last digits of a product depend on what else is in the batch
            grades = [pa.array(out), pa.array((out >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *grades], names=[*batch.schema.names, "score", "predicted"])

    kind = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(work, kind)
