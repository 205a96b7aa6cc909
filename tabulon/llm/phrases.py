"""Phrases of words that stand together more often than chance, from sorted streams of counts.

Every position of a piece of text is the start of one record: its word and up to four that follow. Records lie in prefix order
(by first word, then second, ...), so all positions that begin with the same words follow one another, and one pass over the
sorted records gives the counts of phrases of every length. The counts then lie as a stream in prefix order, where a phrase meets its first
parts, and in suffix order, where it meets its rest; both are merged in lockstep with the stream of phrases cut in two, by
Spark's sort-merge join, and so are the extensions by one word to the right and to the left.

What cannot reach the least count is left out before it is sorted: a phrase is never more frequent than a pair of words in
it. Words and pairs are counted first, all of them; the frequent pairs set the bits of a filter of fixed size, and records go only as far as
such pairs follow one another. A set bit may lie (the exact counts decide later), an empty one never does.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .steps import Steps, partitions
from .words import LOWER, column_bytes, mix, ranges

LEAST = 100
LONGEST = 5
TOP = 2000
#: Bits of a filter (4 MB); it passes through the driver, its size does not depend on the input.
FILTER_BITS = 1 << 25
#: Bytes of text worked on at a time (a longer text stands alone).
PART = 1 << 20
UNKNOWN = "und"

# 0: part of a word, 1: between words, 2: ends a piece
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = 1
CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]
_PAIR = np.uint64(0xA0761D6478BD642F)


class Words:
    """The words of a run of texts: a number per place, in order, and where a piece begins. Equal numbers: same language, same word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: pa.Array):
        kind = CLASS[data]
        inside = kind == 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        breaks = offsets[1:-1]
        breaks = breaks[(breaks > 0) & (breaks < len(data))]
        first[breaks] = inside[breaks]
        last[breaks - 1] = inside[breaks - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        ends = np.append(0, np.cumsum(end - start))
        text = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(LOWER[data[inside]])))
        found = text.dictionary_encode()
        self.text, code = found.dictionary, found.indices.to_numpy().astype(np.int64)
        tongue = langs.dictionary_encode()
        self.tongues = tongue.dictionary
        row = np.searchsorted(offsets, start, "right") - 1
        width = max(len(self.text), 1)
        both, self.number, self.counts = np.unique(tongue.indices.to_numpy()[row] * width + code, return_inverse=True, return_counts=True)
        self.lang, self.word = (both // width).astype(np.int32), (both % width).astype(np.int32)
        stops = np.append(0, np.cumsum(kind == 2))
        self.begins = np.ones(len(start), bool)
        self.begins[1:] = (stops[start[1:]] != stops[end[:-1]]) | (row[1:] != row[:-1])

    def hashes(self) -> np.ndarray:
        return word_hash(self.text, self.word, self.tongues, self.lang)

    def lang_of(self, numbers) -> pa.Array:
        return self.tongues.take(pa.array(self.lang[numbers]))

    def text_of(self, numbers) -> pa.Array:
        return self.text.take(pa.array(self.word[numbers]))


def word_hash(text: pa.Array, word: np.ndarray, tongues: pa.Array, lang: np.ndarray) -> np.ndarray:
    """64 bits of a language and a word, given by their places in ``tongues`` and ``text``."""
    words, langs = (
        pd.util.hash_array(x.to_numpy(zero_copy_only=False), categorize=False) if len(x) else np.zeros(0, np.uint64) for x in (text, tongues)
    )
    return mix(words[word] ^ mix(langs[lang]))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _PAIR + b)


class Filter:
    """Which hashes may belong to a frequent pair."""

    def __init__(self, bits: bytes):
        self.bits = bits

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        slots = np.frombuffer(self.bits, np.uint64)
        at = hashes % np.uint64(FILTER_BITS)
        return (slots[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _filter(pairs: DataFrame) -> Filter:
    """Bits of the hashes of ``pairs`` (lang, phrase): at most ``FILTER_BITS / 64`` numbers reach the driver."""

    def work(batches):
        for batch in batches:
            tongues = batch.column(0).dictionary_encode()
            words = pc.list_flatten(pc.split_pattern(batch.column(1), " ")).dictionary_encode()
            code, lang = words.indices.to_numpy(), tongues.indices.to_numpy()
            a, b = (word_hash(words.dictionary, code[k::2], tongues.dictionary, lang) for k in (0, 1))
            at = pair_hash(a, b) % np.uint64(FILTER_BITS)
            bit = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(bit.view(np.int64))], names=["at", "bits"])

    found = pairs.select("lang", "phrase").mapInArrow(work, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found["at"].to_numpy()] = found["bits"].to_numpy()
    return Filter(bits.tobytes())


def _runs(docs: DataFrame, make, kind: str) -> DataFrame:
    """``make(words)`` for every run of texts of every batch."""

    def work(batches):
        for batch in batches:
            langs = pc.fill_null(batch.column(0).cast(pa.large_string()), UNKNOWN)
            data, offsets = column_bytes(batch.column(1))
            for lo, hi in ranges(offsets, PART):
                if offsets[hi] > offsets[lo]:
                    words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], langs[lo:hi])
                    if len(words.number):
                        yield make(words)

    return docs.select("lang", "text").mapInArrow(work, kind)


def _batch(words: Words, first: np.ndarray, columns: list[pa.Array], names: list[str], counts: np.ndarray) -> pa.RecordBatch:
    arrays = [words.lang_of(first), *columns]
    return pa.RecordBatch.from_arrays([*(a.cast(pa.string()) for a in arrays), pa.array(counts.astype(np.int64))], names=["lang", *names, "n"])


def _singles(words: Words) -> pa.RecordBatch:
    every = np.arange(len(words.counts))
    return _batch(words, every, [words.text_of(every)], ["phrase"], words.counts)


def _pairs(words: Words) -> pa.RecordBatch:
    at, size = np.flatnonzero(~words.begins[1:]), len(words.counts)
    pair, n = np.unique(words.number[at] * size + words.number[at + 1], return_counts=True)
    a, b = pair // size, pair % size
    text = pc.binary_join_element_wise(words.text_of(a), words.text_of(b), pa.scalar(" ", pa.large_string()))
    return _batch(words, a, [text], ["phrase"], n)


def _records(words: Words, frequent: Filter) -> pa.RecordBatch:
    """Positions whose next two pairs are frequent, with as many of the next words as frequent pairs tie to them."""
    hashes, size, total = words.hashes(), len(words.counts), len(words.number)
    tied = np.zeros(total, bool)  # this word and the next one
    near = np.flatnonzero(~words.begins[1:])
    a, b = words.number[near], words.number[near + 1]
    tied[near] = frequent(pair_hash(hashes[a], hashes[b]))
    on = np.append(tied, np.zeros(LONGEST, bool))
    at = np.flatnonzero(tied & on[1 : total + 1])
    # a row of numbers a position, -1 behind its end; equal rows are counted together
    table = np.full((len(at), LONGEST), -1, np.int64)
    table[:, 0], going = words.number[at], np.ones(len(at), bool)
    for k in range(1, LONGEST):
        going &= on[at + k - 1]
        table[going, k] = words.number[at[going] + k]
    key, rows = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for k in range(LONGEST):
        _, rows, key = np.unique(key * (size + 1) + table[:, k] + 1, return_index=True, return_inverse=True)
    rows, n = table[rows], np.bincount(key, minlength=len(rows))
    columns = [pc.if_else(pa.array(rows[:, k] >= 0), words.text_of(np.maximum(rows[:, k], 0)), pa.scalar(None, pa.large_string())) for k in range(LONGEST)]
    return _batch(words, rows[:, 0], columns, WORDS, n)


class _Stream:
    """Counts of the first ``m`` words, for every ``m``, of records in prefix order."""

    def __init__(self, least: int):
        self.least, self.last, self.sums, self.first = least, None, dict.fromkeys(range(3, LONGEST + 1), 0), set(range(3, LONGEST + 1))

    def feed(self, batch: pa.RecordBatch) -> pa.Table:
        """Counts of the phrases that end in this batch. Those that may go on in another partition come whatever their count."""
        rows = pa.Table.from_batches([batch])
        if self.last is not None:  # the row before, as a row without a count
            rows = pa.concat_tables([self.last, rows])
        n = rows["n"].to_numpy().copy()
        changed = np.ones(len(n), bool)
        changed[1:] = False
        out = []
        for m, name in enumerate(["lang", *WORDS]):
            code = pc.fill_null(rows[name].combine_chunks().dictionary_encode().indices, -1).to_numpy()
            changed[1:] |= code[1:] != code[:-1]
            if m < 3:
                continue
            start = np.flatnonzero(changed)
            sums = np.add.reduceat(n, start)
            if self.last is not None:
                sums[0] += self.sums[m]
            full = code[start] >= 0
            keep = full & (sums >= self.least)
            if m in self.first:  # until a second phrase begins, the first may have begun in the partition before
                keep[0] = full[0]
                if len(start) > 1:
                    self.first.discard(m)
            keep[-1] = False  # may go on in the next batch
            self.sums[m] = int(sums[-1])
            chosen = rows.take(pa.array(start[keep]))
            phrase = pc.binary_join_element_wise(*[chosen[w].cast(pa.string()) for w in WORDS[:m]], " ")
            out.append(pa.table([chosen["lang"], phrase, pa.array(sums[keep])], names=["lang", "phrase", "n"]))
        last = rows.slice(len(n) - 1, 1)
        self.last = last.set_column(last.schema.get_field_index("n"), "n", pa.array([0], pa.int64()))
        return pa.concat_tables(out).combine_chunks()

    def close(self) -> pa.RecordBatch:
        """The phrases still open behind the last row."""
        row = self.last.to_pylist()[0]
        words = [row[w] for w in WORDS]
        out = [(row["lang"], " ".join(words[:m]), n) for m, n in self.sums.items() if words[m - 1] is not None]
        return pa.RecordBatch.from_pydict(dict(zip(["lang", "phrase", "n"], zip(*out) if out else [[]] * 3)), pa.schema(
            {"lang": pa.string(), "phrase": pa.string(), "n": pa.int64()}.items()))


def _long_counts(records: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of the phrases of three words or more, from one pass over the records in prefix order."""

    def work(batches):
        stream = _Stream(least)
        for batch in batches:
            if batch.num_rows:
                yield from stream.feed(batch).to_batches()
        if stream.last is not None:
            yield stream.close()

    order = ["lang", *WORDS]
    placed = records.repartitionByRange(partitions(records.sparkSession), *order).sortWithinPartitions(*order)
    found = placed.select(*order, "n").mapInArrow(work, "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def count_phrases(docs: DataFrame, steps: Steps, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, n) of all phrases of up to five words with ``least`` occurrences or more, and (lang, total) of all words."""
    def counted(make):
        return _runs(docs, make, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))

    singles = steps.write(counted(_singles))
    totals = steps.write(singles.groupBy("lang").agg(F.sum("n").alias("total")))
    pairs = steps.write(counted(_pairs).filter(F.col("n") >= least))
    tied = _filter(pairs)
    kind = f"lang string, {', '.join(f'{w} string' for w in WORDS)}, n long"
    records = steps.write(_runs(docs, lambda w: _records(w, tied), kind).groupBy("lang", *WORDS).agg(F.sum("n").alias("n")))
    counts = singles.filter(F.col("n") >= least).union(pairs).union(_long_counts(records, least))
    counts = steps.write(counts.select("lang", "phrase", (F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1).alias("m"), "n"))
    steps.drop(singles, pairs, records)
    return counts, totals


def _words(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = 100) -> DataFrame:
    """The first ``top`` phrases of every language: (lang, rank, phrase, a, l, r, n, score).

    Words are maximal runs without blanks and tabs in lower case (A-Z), pieces end at ``.,;:!?`` and line ends, whole texts are read. A null
    text is empty, a null lang ``und``; repeated rows count as often as they stand; other columns of ``docs`` are not read. Candidates are phrases
    of two to five words with ``least`` occurrences or more; the score is ``floor(1000 * a * n / (l * r))`` at the cut where it is least, the
    first of equal ones. A candidate goes if a longer one holds it and has at least ``covered`` percent of its occurrences;
    every occurrence of the longer one is one of the shorter, and so of all between them, so extensions by one word decide this.
    Without a word, or without a candidate, a language has no row.
    """
    if covered != 100 and not 0 < covered <= 100:
        raise ValueError("covered is a share in percent")
    steps = Steps(docs.sparkSession, "phrases")
    counts, totals = count_phrases(docs, steps, least)
    cand = counts.filter("m > 1").select("lang", "phrase", "m", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    k = F.col("k")
    cuts = cand.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", _words(F.lit(1), k).alias("head"), _words(k + 1, F.col("m") - k).alias("rest"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(heads.hint("merge"), ["lang", "head"]).join(rests.hint("merge"), ["lang", "rest"])
    # a language may hold most of the phrases: its total stands once per part
    parts = partitions(docs.sparkSession)
    totals = totals.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    cuts = cuts.withColumn("part", F.pmod(F.hash("phrase"), F.lit(parts))).join(totals.hint("merge"), ["lang", "part"])
    # whole numbers of up to 38 digits; the quotient is at most 1000 * n / max(l, r)
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(total as decimal(17,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "total")).alias("x")
    scored = cuts.groupBy("lang", "phrase").agg(best).select("lang", "phrase", "x.*")
    # extensions by one word: a candidate less its last word, and less its first
    wide = cand.filter("m > 2")
    inner = wide.select("lang", _words(F.lit(1), F.col("m") - 1).alias("phrase"), "a").union(wide.select("lang", _words(F.lit(2), F.col("m") - 1), "a"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("wider"))
    scored = scored.join(inner.hint("merge"), ["lang", "phrase"], "left").filter(f"wider is null or 100 * wider < {int(covered)} * a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = scored.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
