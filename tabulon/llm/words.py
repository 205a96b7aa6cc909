"""Words and shingles of many texts at once, as NumPy arrays over the bytes of an Arrow column.

Runs inside Python tasks only. Words are maximal runs of bytes other than ``\\x20`` and ``\\x09-\\x0D``.
Hashes have 64 bits. Work goes in pieces of about a megabyte, so memory follows the longest word
and the number of words, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
PLAIN = np.arange(256, dtype=np.uint8)
LOWER = PLAIN.copy()
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(name: str, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        step = _BASE if name == "up" else pow(_BASE, -1, 1 << 64)
        out = np.full(max(n, PIECE), step, np.uint64)
        out[0] = 1
        _powers[name] = np.multiply.accumulate(out)
    return _powers[name][:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def ranges(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``limit`` bytes together; a longer text stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def _piece(data: np.ndarray, breaks: np.ndarray, fold: np.ndarray):
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    breaks = breaks[(breaks > 0) & (breaks < len(data))]
    first[breaks] = inside[breaks]
    last[breaks - 1] = inside[breaks - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((fold[data].astype(np.uint64) + np.uint64(1)) * _power("up", len(data)), out=total[1:])
    value = (total[end] - total[start]) * _power("down", len(data))[start] if len(start) else np.zeros(0, np.uint64)
    return start, end, mix(value ^ (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """(start, end, hash) of every word, in byte positions of ``data``."""
    fold, parts = LOWER if lower else PLAIN, []
    for lo, hi in ranges(offsets):
        at, stop = int(offsets[lo]), int(offsets[hi])
        while at < stop:
            end = stop
            if end - at > 2 * PIECE:  # one long text: cut it at white space
                space = np.flatnonzero(SPACE[data[at : at + PIECE]])
                reach = at + PIECE
                while not len(space) and reach < stop:  # a word longer than a piece stays whole
                    space = np.flatnonzero(SPACE[data[reach : reach + PIECE]]) + (reach - at)
                    reach += PIECE
                end = at + int(space[-1]) + 1 if len(space) else stop
            s, e, h = _piece(data[at:end], offsets[lo:hi] - at, fold)
            parts.append((s + at, e + at, h))
            at = end
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


@dataclass
class Shingles:
    """Distinct shingle hashes of texts, sorted in each text; text ``i`` owns ``hashes[bounds[i]:bounds[i + 1]]``."""

    hashes: np.ndarray
    bounds: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    def set_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Two order-free 64-bit sums over each set: equal sets, equal numbers."""
        return tuple(self._fold(np.add, mix(self.hashes ^ _ODD[k])) for k in (0, 1))

    def signatures(self, count: int) -> np.ndarray:
        """``count`` minima per set under seeded hash functions, 32 bits each; rows of empty sets hold 0."""
        seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * _ODD[2])
        out = np.zeros((len(self.bounds) - 1, count), np.int32)
        for lo, hi in ranges(self.bounds, 1 << 16):
            part = Shingles(self.hashes[self.bounds[lo] : self.bounds[hi]], self.bounds[lo : hi + 1] - self.bounds[lo])
            for k in range(count):
                value = (part.hashes ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1))
                out[lo:hi, k] = (part._fold(np.minimum, value) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return out

    def _fold(self, how, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.bounds) - 1, np.uint64)
        full = np.flatnonzero(np.diff(self.bounds))
        if len(full):
            out[full] = how.reduceat(values, self.bounds[:-1][full])
        return out


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, owner) of all runs of ``width`` words; an owner with fewer words has its whole sequence as one."""
    n = len(words)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at, stop, begin = np.arange(n), bounds[1:][owner], bounds[:-1][owner]
    total = np.zeros(n, np.uint64)
    for k in range(width):
        there = np.zeros(n, np.uint64)
        there[: n - k] = words[k:] if k else words
        there[at + k >= stop] = 0
        total = (total + there) * _ODD[k % len(_ODD)] + np.uint64(k)
    total = mix(total ^ np.minimum(stop - at, width).astype(np.uint64))
    keep = (at + width <= stop) | (at == begin)
    return total[keep], owner[keep]


def distinct(hashes: np.ndarray, owner: np.ndarray, owners: int) -> Shingles:
    # owner and the hash's upper bits sort as one number; only where these leave the order open both are sorted
    low = np.uint64(max(1, int(owners).bit_length()))
    order = np.argsort((owner.astype(np.uint64) << (np.uint64(64) - low)) | (hashes >> low))
    sorted_hashes, sorted_owner = hashes[order], owner[order]
    if np.any((sorted_hashes[1:] < sorted_hashes[:-1]) & (sorted_owner[1:] == sorted_owner[:-1])):
        order = np.lexsort((hashes, owner))
        sorted_hashes, sorted_owner = hashes[order], owner[order]
    hashes, owner = sorted_hashes, sorted_owner
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[first], owner[first]
    return Shingles(hashes, np.searchsorted(owner, np.arange(owners + 1)))


def text_shingles(column: pa.Array, width: int = 5) -> Iterator[tuple[int, int, Shingles]]:
    """Distinct lower-case shingles of a string column, a run of rows at a time: (first row, end row, shingles)."""
    data, offsets = column_bytes(column)
    for lo, hi in ranges(offsets, 2 * PIECE):
        base = offsets[lo]
        start, _, words = word_hashes(data[base : offsets[hi]], offsets[lo : hi + 1] - base)
        bounds = np.searchsorted(start, offsets[lo : hi + 1] - base)
        yield lo, hi, distinct(*shingle_hashes(words, bounds, width), hi - lo)
