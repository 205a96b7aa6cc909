"""Token counts of whole texts under a merge-based piece vocabulary, by rank-synchronous merging of ragged arrays.

A text is cut into pre-tokens wherever no piece holds its two neighbouring characters side by side: no symbol can ever
span such a place, so the merges on either side do not see each other. Distinct pre-tokens of a piece of a batch lie one
behind another in one NumPy array of symbols. Every round finds each sequence's pair of lowest rank and merges its
occurrences at once, from left to right; a sequence where a merge makes a pair of the same or a lower rank stops
behind that merge, so the order is that of a merge-by-merge encoder. What survives is counted: a symbol that is a piece is
one token, a character that is none goes to one byte token per UTF-8 byte.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import ranges

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
LIMIT = 4096
#: Characters worked on at a time (a longer text stands alone).
PART = 1 << 21
NEVER = np.iinfo(np.int32).max


@dataclass
class Vocabulary:
    """Pieces with their scores as read from a model file; the tables for merging are built once per worker."""

    scores: dict[str, float]
    prefix: bool = True  # a blank is set before every text that is not empty
    _ready: tuple = field(default=None, repr=False)

    def __getstate__(self):
        return {"scores": self.scores, "prefix": self.prefix, "_ready": None}

    def tables(self) -> Merges:
        if self._ready is None:
            self._ready = (Merges(self.scores),)
        return self._ready[0]


def load_vocabulary(path: str | None = None) -> Vocabulary:
    """The vocabulary of a model file (read on the driver; its size is the vocabulary's, whatever the corpus)."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    # the blank set before a text shows in the pieces of a text that has none
    return Vocabulary({model.id_to_piece(i): model.get_score(i) for i in plain}, "".join(model.encode("a", out_type=str)).startswith(BLANK))


class Merges:
    """Symbols are pieces and the characters that pieces consist of, by number."""

    def __init__(self, scores: dict[str, float]):
        letters = sorted({c for piece in scores for c in piece})
        # characters first, so a character's number also addresses the table of neighbours
        symbols = letters + [p for p in scores if len(p) > 1]
        number = {s: i for i, s in enumerate(symbols)}
        self.size = len(symbols)
        self.cost = np.array([1 if s in scores else len(s.encode()) for s in symbols], np.int64)
        self.letter = np.full(0x110000, -1, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(len(letters), dtype=np.int32)
        self.beside = np.zeros((len(letters), len(letters)), bool)
        level = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = {}
        for piece, score in scores.items():
            for k in range(1, len(piece)):
                self.beside[number[piece[k - 1]], number[piece[k]]] = True
                if (left := number.get(piece[:k])) is not None and (right := number.get(piece[k:])) is not None:
                    pairs[left * self.size + right] = (level[score], number[piece])
        self.keys = np.array(sorted(pairs), np.int64)
        found = np.array([pairs[k] for k in self.keys.tolist()], np.int32).reshape(-1, 2)
        self.ranks, self.made = np.append(found[:, 0], NEVER), np.append(found[:, 1], -1)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs in ``ranks`` and ``made``; the last place for a pair that never merges."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == key[known]
        return np.where(known, at, len(self.keys))

    def count(self, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of every sequence; sequence ``i`` starts with ``symbols[bounds[i]:bounds[i + 1]]``, none empty."""
        out = np.zeros(len(bounds) - 1, np.int64)
        names, sizes = np.arange(len(out)), np.diff(bounds)
        symbols = symbols.astype(np.int64)
        pair = np.full(len(symbols), len(self.keys))
        pair[:-1] = self.find(symbols[:-1], symbols[1:])
        pair[np.cumsum(sizes) - 1] = len(self.keys)
        while len(names):
            begin = np.cumsum(sizes) - sizes
            rank = self.ranks[pair]
            low = np.minimum.reduceat(rank, begin)
            ready = low == NEVER
            if ready.any():
                out[names[ready]] = np.add.reduceat(self.cost[symbols], begin)[ready]
                stay = np.repeat(~ready, sizes)
                symbols, pair, rank = symbols[stay], pair[stay], rank[stay]
                names, sizes, low = names[~ready], sizes[~ready], low[~ready]
                if not len(names):
                    break
            own = np.repeat(np.arange(len(names)), sizes)
            at = np.flatnonzero(rank == low[own])
            # of neighbouring pairs of the lowest rank every other one merges, from the left
            first = np.ones(len(at), bool)
            first[1:] = at[1:] != at[:-1] + 1
            order = np.arange(len(at))
            at = at[(order - np.maximum.accumulate(np.where(first, order, 0))) % 2 == 0]
            at = self._in_order(at, symbols, pair, own, low)
            symbols[at] = self.made[pair[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            owner = own[at]
            sizes = sizes - np.bincount(owner, minlength=len(names))
            at = at - np.arange(len(at))  # as many symbols fewer before it as merges before it
            symbols, pair, own = symbols[keep], pair[keep], own[keep]
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(symbols) - 1)
                inside = (right > left) & (own[left] == own[right])
                pair[left] = np.where(inside, self.find(symbols[left], symbols[right]), len(self.keys))
        return out

    def _in_order(self, at, symbols, pair, own, low):
        """The merges that a merge-by-merge encoder makes before it meets a new pair of the same or a lower rank."""
        owner = own[at]
        several = np.bincount(owner, minlength=len(low))[owner] > 1
        if not several.any():
            return at
        some = np.flatnonzero(several)
        p, o = at[some], owner[some]
        made = self.made[pair[p]].astype(np.int64)
        last = len(symbols) - 1
        right = np.minimum(p + 2, last)
        new = np.where((p + 2 <= last) & (own[right] == o), self.ranks[self.find(made, symbols[right])], NEVER)
        before = np.maximum(p - 1, 0)
        beside = symbols[before]
        joined = np.zeros(len(p), bool)
        joined[1:] = (p[1:] - 2 == p[:-1]) & (o[1:] == o[:-1])
        beside[joined] = made[np.flatnonzero(joined) - 1]
        new = np.minimum(new, np.where((p > 0) & (own[before] == o), self.ranks[self.find(beside, made)], NEVER))
        early = new <= low[o]
        seen = np.cumsum(early) - early  # such pairs before this one, in any sequence
        start = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
        late = seen > np.repeat(seen[start], np.diff(np.append(start, len(o))))
        drop = np.zeros(len(at), bool)
        drop[some[late]] = True
        return at[~drop]

    def texts(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of every text; ``points`` are code points, text ``i`` owns ``points[bounds[i]:bounds[i + 1]]``."""
        if not len(points):
            return np.zeros(len(bounds) - 1, np.int64)
        letter = self.letter[points]
        cut = np.ones(len(points), bool)
        both = (letter[1:] >= 0) & (letter[:-1] >= 0)
        cut[1:] = ~(both & self.beside[letter[:-1], letter[1:]])
        cut[bounds[:-1][np.diff(bounds) > 0]] = True
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(points)))
        # a character no piece holds stands alone: one token a byte
        alone = 1 + (points[begin] > 0x7F) + (points[begin] > 0x7FF) + (points[begin] > 0xFFFF)
        tokens = np.where(letter[begin] < 0, alone, self.cost[np.maximum(letter[begin], 0)])
        many = np.flatnonzero(size > 1)
        if len(many):
            wide = np.repeat(size > 1, size)
            ends = np.append(0, np.cumsum(size[many]))
            runs = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(many), [None, pa.py_buffer((ends * 4).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(letter[wide]))]
            ).dictionary_encode()
            _, at, data = runs.dictionary.buffers()
            at = np.frombuffer(at, np.int64)[: len(runs.dictionary) + 1] // 4
            tokens[many] = self.count(np.frombuffer(data, np.int32)[: at[-1]], at)[runs.indices.to_numpy()]
        total = np.append(0, np.cumsum(tokens))
        where = np.searchsorted(begin, bounds)
        return total[where[1:]] - total[where[:-1]]


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): (doc_id, n_bytes, n_tokens, over_limit).

    Whole texts are counted, without begin or end marks; strings of special tokens inside a text are plain text. A null
    text counts as empty: no bytes, no tokens. Repeated rows and rows without a doc_id stay, one result each; other
    columns of ``docs`` are not read. No shuffle: a batch of rows is one piece of work.
    """

    def work(batches):
        merges = vocabulary.tables()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            sizes = np.array([len(t) + vocabulary.prefix if t else 0 for t in texts], np.int64)
            bounds, parts = np.append(0, np.cumsum(sizes)), []
            for lo, hi in ranges(bounds, PART):
                joined = "".join((" " + t if vocabulary.prefix else t) if t else "" for t in texts[lo:hi])
                points = np.frombuffer(joined.replace(" ", BLANK).encode("utf-32-le"), np.uint32)
                parts.append(merges.texts(points, bounds[lo : hi + 1] - bounds[lo]))
            tokens = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            lengths = np.array([len(t.encode()) if t else 0 for t in texts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths), pa.array(tokens), pa.array(tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
