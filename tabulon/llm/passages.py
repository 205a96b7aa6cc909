"""Repeated passages by MinHash banding of paragraphs.

Passages repeat in the middle of other text, so paragraphs are cut where the content says: at places whose next three words have the
least hash of all places up to ``REACH`` before and after, and where such places lie far apart, up to ``NEAR`` before and
after. The same passage is thus cut alike wherever it stands.
Paragraphs collide in bands of their MinHash signature, colliding ones are verified by exact Jaccard similarity of
their shingle sets, components of the verified pairs are classes. Of every class the first occurrence stays. Runs of
later ones are extended word by word, before and behind, as far as the text agrees with the text around the first occurrence; runs of
``MIN_WORDS`` words or more are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .graph import bucket_components
from .steps import Steps
from .words import PIECE, Shingles, column_bytes, distinct, mix, ranges, shingle_hashes, word_hashes

WIDTH = 5
REACH = 5
NEAR = 2
#: Bands and rows per band: a pair at similarity 0.8 collides with probability 0.97 (1 - (1 - 0.8 ** 3) ** 5), at 0.3 with 0.13, at 1 always.
BANDS = 5
ROWS = 3
PERCENT = 80
#: Shorter repetitions are common turns of speech, not passages.
MIN_WORDS = 12
#: Rows of a hot band key that one task compares with the others of the key.
SPLIT = 512

_CUT = np.uint64(0xA24BAED4963EE407)
_SECOND = np.uint64(0x9FB21C651E98DF25)
_THIRD = np.uint64(0xD6E8FEB86659FD93)


def _least(value: np.ndarray, begin: np.ndarray, stop: np.ndarray, reach: int) -> np.ndarray:
    """Places whose value is below those up to ``reach`` before and not above those behind, with ``reach`` places of the text on either side."""
    place, n = np.arange(len(value)), len(value)
    least = (place - begin >= reach) & (stop - place > reach)
    for k in range(1, min(reach, n - 1) + 1):
        least[k:] &= value[k:] < value[:-k]
        least[:-k] &= value[:-k] <= value[k:]
    return least


def cut_words(words: np.ndarray, bounds: np.ndarray, reach: int) -> np.ndarray:
    """Index of the first word of every paragraph. Text ``i`` owns ``words[bounds[i]:bounds[i + 1]]``."""
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place, begin, stop = np.arange(n), bounds[:-1][owner], bounds[1:][owner]
    value = mix(words ^ _CUT)
    for k, factor in ((1, _SECOND), (2, _THIRD)):
        there = np.zeros(n, np.uint64)
        there[: n - k] = words[k:]
        there[place + k >= stop] = 0
        value = value + mix(there * factor)
    value = mix(value)
    least = _least(value, begin, stop, reach)
    # no such place up to 2 * reach before and behind: nearer ones do
    total = np.concatenate([[0], np.cumsum(least)])
    far = total[np.minimum(place + 2 * reach + 1, stop)] == total[np.maximum(place - 2 * reach, begin)]
    least |= far & _least(value, begin, stop, min(NEAR, reach))
    least[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(least)


class _Run:
    """Paragraphs of a run of rows: words, first word of each paragraph, paragraph bounds per row, character places."""

    def __init__(self, piece: np.ndarray, local: np.ndarray, reach: int):
        self.start, self.end, self.words = word_hashes(piece, local)
        self.bounds = np.searchsorted(self.start, local)
        self.first = cut_words(self.words, self.bounds, reach)
        self.stops = np.append(self.first, len(self.words))
        self.per_row = np.searchsorted(self.first, self.bounds)
        chars = np.concatenate([[0], np.cumsum((piece & 0xC0) != 0x80)])
        row = np.repeat(np.arange(len(local) - 1), np.diff(self.bounds))
        # of every word: characters of its text before its first and its last
        self.begin, self.finish = chars[self.start] - chars[local[row]], chars[self.end] - chars[local[row]]

    def picked(self, wanted: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(paragraph, row) of the wanted places of the rows ``lo`` to ``hi``."""
        pick = [self.per_row[k - lo] + np.sort(wanted[k].values.to_numpy()) for k in range(lo, hi)]
        pick = np.concatenate(pick).astype(np.int64)
        return pick, np.searchsorted(self.per_row, pick, "right") - 1


def _runs(column: pa.Array, reach: int):
    data, offsets = column_bytes(column)
    for lo, hi in ranges(offsets, PIECE):
        base = offsets[lo]
        yield lo, hi, _Run(data[base : offsets[hi]], offsets[lo : hi + 1] - base, reach)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


def band_keys(sets: Shingles, bands: int, rows: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, paragraph). Sets too small to be similar without being equal have the one key of the whole set."""
    a, _ = sets.set_ids()
    small = 100 * sets.sizes() < percent * (sets.sizes() + 1)
    grid = sets.signatures(bands * rows).view(np.uint32).astype(np.uint64)
    keys, owners = [mix(a[small] ^ np.uint64(1))], [np.flatnonzero(small)]
    for band in range(bands):
        key = np.full(len(a), band + 2, np.uint64)
        for r in range(rows):
            key = mix(key ^ grid[:, band * rows + r]) + np.uint64(band)
        keys.append(key[~small])
        owners.append(np.flatnonzero(~small))
    return np.concatenate(keys), np.concatenate(owners)


def band_posts(docs: DataFrame, bands: int, rows: int, reach: int, width: int, percent: int) -> DataFrame:
    """(key, doc_id, version, pos): every paragraph under its keys."""

    def work(batches):
        for batch in batches:
            ids, versions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, _, run in _runs(batch.column(2), reach):
                sets = distinct(*shingle_hashes(run.words, run.stops, width), len(run.first))
                key, paragraph = band_keys(sets, bands, rows, percent)
                row = np.searchsorted(run.per_row, paragraph, "right") - 1
                pos = (paragraph - run.per_row[row]).astype(np.int32)
                yield pa.record_batch({"key": pa.array(key.view(np.int64)), "doc_id": pa.array(ids[lo + row]), "version": pa.array(versions[lo + row]), "pos": pa.array(pos)})

    return docs.select("doc_id", "version", "text").mapInArrow(work, "key long, doc_id long, version long, pos int")


def shared_posts(posts: DataFrame) -> DataFrame:
    """The rows of ``posts`` whose key, the first column, stands in more than one row.

    Rows are dealt and sorted by key once, so they are made once; neighbours tell whether a key is shared, and a task holds one batch and
    the last row before it, however many rows a key has.
    """

    def work(batches):
        last, sent = None, False  # the last row so far, and whether it has gone out
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            same = key[1:] == key[:-1]
            more = np.append(same, False) | np.insert(same, 0, False)
            if last is not None and last.column(0)[0].as_py() == key[0]:
                more[0] = True
                if not sent:
                    yield last
            last, sent = batch.slice(batch.num_rows - 1), bool(more[-1])
            yield batch.filter(pa.array(more))

    return posts.repartition("key").sortWithinPartitions("key").mapInArrow(work, posts.schema)


def keyed_sets(sets: DataFrame, bands: int, rows: int, percent: int) -> DataFrame:
    """``sets`` (shingles, anything else) with ``keys``, those of ``band_keys`` without repetition."""

    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(batch.schema.get_field_index("shingles"))
            bounds, hashes = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy().view(np.uint64)
            key, owner = band_keys(Shingles(hashes[bounds[0] : bounds[-1]], bounds - bounds[0]), bands, rows, percent)
            order = np.lexsort((key.view(np.int64), owner))
            ends = np.searchsorted(owner[order], np.arange(len(lists) + 1)).astype(np.int32)
            yield batch.append_column("keys", pa.ListArray.from_arrays(pa.array(ends), pa.array(key[order].view(np.int64))))

    schema = StructType([*sets.schema, StructField("keys", ArrayType(LongType()))])
    return sets.mapInArrow(work, schema).withColumn("keys", F.array_distinct("keys"))


def paragraph_sets(docs: DataFrame, reach: int, width: int) -> DataFrame:
    """(doc_id, version, pos, word, n_words, begin, finish, a, b, shingles) of the paragraphs of ``docs`` (doc_id, version, text, wanted array of pos)."""
    kind = "doc_id long, version long, pos int, word long, n_words long, begin long, finish long, a long, b long, shingles array<long>"

    def work(batches):
        for batch in batches:
            ids, versions, wanted = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            for lo, hi, run in _runs(batch.column(2), reach):
                pick, row = run.picked(wanted, lo, hi)
                sets = distinct(*shingle_hashes(run.words, run.stops, width), len(run.first))
                a, b = sets.set_ids()
                first, last = run.stops[pick], run.stops[pick + 1] - 1
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(ids[lo + row]),
                        "version": pa.array(versions[lo + row]),
                        "pos": pa.array((pick - run.per_row[row]).astype(np.int32)),
                        "word": pa.array((first - run.bounds[row]).astype(np.int64)),
                        "n_words": pa.array((last + 1 - first).astype(np.int64)),
                        "begin": pa.array(run.begin[first].astype(np.int64)),
                        "finish": pa.array(run.finish[last].astype(np.int64)),
                        "a": pa.array(a[pick].view(np.int64)),
                        "b": pa.array(b[pick].view(np.int64)),
                        "shingles": _lists([sets.hashes[sets.bounds[p] : sets.bounds[p + 1]].view(np.int64) for p in pick]),
                    }
                )

    return docs.select("doc_id", "version", "text", "wanted").mapInArrow(work, kind)


def surroundings(docs: DataFrame, reach: int) -> DataFrame:
    """(doc_id, version, pos, n, before, begins, after, finishes): the words of a place (n of them) and on either side of it, backwards and onwards, as
    hashes, and the characters at which they begin or finish; as far as two paragraphs go, and ``8 * reach`` words at least.

    A common run ends in these. Whether a word begins a paragraph depends on ``3 * reach + 2`` words around it, so farther inside the run
    both texts are cut alike, and a whole paragraph more there would be a place of its own."""
    kind = "doc_id long, version long, pos int, n int, before array<long>, begins array<long>, after array<long>, finishes array<long>"

    def work(batches):
        for batch in batches:
            ids, versions, wanted = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            for lo, hi, run in _runs(batch.column(2), reach):
                pick, row = run.picked(wanted, lo, hi)
                words = run.words.view(np.int64)
                low, high = run.stops[np.maximum(pick - 2, run.per_row[row])], run.stops[np.minimum(pick + 3, run.per_row[row + 1])]
                first, stop = run.stops[pick], run.stops[pick + 1]
                low, high = np.minimum(low, first - 8 * reach), np.maximum(high, stop + 8 * reach)
                low, high = np.maximum(low, run.bounds[row]), np.minimum(high, run.bounds[row + 1])
                before = [slice(i, j) for i, j in zip(low, stop)]
                after = [slice(i, j) for i, j in zip(first, high)]
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(ids[lo + row]),
                        "version": pa.array(versions[lo + row]),
                        "pos": pa.array((pick - run.per_row[row]).astype(np.int32)),
                        "n": pa.array((stop - first).astype(np.int32)),
                        "before": _lists([words[s][::-1] for s in before]),
                        "begins": _lists([run.begin[s][::-1] for s in before]),
                        "after": _lists([words[s] for s in after]),
                        "finishes": _lists([run.finish[s] for s in after]),
                    }
                )

    return docs.select("doc_id", "version", "text", "wanted").mapInArrow(work, kind)


PLACE = ["doc_id", "version", "pos"]


def _listed(places: DataFrame) -> DataFrame:
    return places.groupBy("doc_id", "version").agg(F.collect_set("pos").alias("wanted"))


def _wanted(listed: DataFrame, docs: DataFrame) -> DataFrame:
    """``docs`` that have places, with the list of them."""
    return docs.join(listed.hint("merge"), ["doc_id", "version"])


def _agreeing(a, b):
    """How many of the first elements of two arrays are equal in pairs."""
    size = F.least(F.size(a), F.size(b))
    differ = F.array_position(F.zip_with(F.slice(a, F.lit(1), size), F.slice(b, F.lit(1), size), lambda x, y: x != y), True)
    return F.when(differ > 0, differ - 1).otherwise(size).cast("int")


def _extended(runs: DataFrame, docs: DataFrame, steps: Steps, reach: int) -> DataFrame:
    """Runs with their ends moved outwards over the words that they have in common with the text around the first occurrence."""
    ends = [runs.select(F.explode(F.array("low", "high", "low_kept", "high_kept")).alias("p"))]
    there = steps.write(surroundings(_wanted(_listed(ends[0].select("p.*").distinct()), docs), reach))

    def beside(rows, place, kept, words, chars):
        own = there.select(F.struct(*PLACE).alias("_p"), F.col("n").alias("_n"), F.col(words).alias("_own"), F.col(chars).alias("_at"))
        other = there.select(F.struct(*PLACE).alias("_q"), F.col("n").alias("_m"), F.col(words).alias("_other"))
        rows = rows.join(own.hint("merge"), F.col(place) == F.col("_p")).join(other.hint("merge"), F.col(kept) == F.col("_q"))
        # near-equal paragraphs may agree from either end on
        rest = lambda x, n: F.slice(x, F.col(n) + 1, F.size(x))
        beyond = F.col("_n") + _agreeing(rest("_own", "_n"), rest("_other", "_m"))
        rows = rows.withColumn("_reach", F.greatest(_agreeing("_own", "_other"), beyond))
        return rows.withColumns({"_more": (F.col("_reach") - F.col("_n")).cast("long"), "_to": F.element_at("_at", F.col("_reach"))})

    rows = beside(runs, "low", "low_kept", "before", "begins")
    rows = rows.withColumns({"word": F.col("word") - F.col("_more"), "begin": F.col("_to")}).select(*runs.columns)
    rows = beside(rows, "high", "high_kept", "after", "finishes")
    return rows.withColumns({"stop": F.col("stop") + F.col("_more"), "finish": F.col("_to")}).select(*runs.columns)


def repeated_passages(
    docs: DataFrame, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, reach: int = REACH, width: int = WIDTH, min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, version, start_char, n_chars, n_words, kept_doc_id), one row per removed passage of ``docs`` (doc_id, text).

    A passage is a run of paragraphs of which each occurs earlier, by doc_id and place, in its class, with the words before and behind it that
    agree with the earlier text; ``kept_doc_id`` has the first occurrence of the run's first paragraph. Positions count code points from 0. Words
    are lower-cased runs without ASCII white space. A null doc_id, null and empty texts have no passages. Rows that repeat
    both doc_id and text are one document; texts that share a doc_id are told apart by ``version``, a hash of the text.
    """
    steps = Steps(docs.sparkSession, "passages")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text").filter("doc_id is not null and text is not null")
    keyed = band_posts(docs, bands, rows, reach, width, percent)
    # only the places are taken from here: sets have their keys at hand, and equal ones have equal keys, so each makes them once more
    met = steps.write(_listed(shared_posts(keyed).select(*PLACE).repartition("doc_id", "version").distinct()))
    sets = steps.write(paragraph_sets(_wanted(met, docs), reach, width))
    n = sets.count()
    place = F.struct(*PLACE)
    spots = sets.select(*PLACE, "word", "n_words", "begin", "finish", "a", "b").distinct()
    items = sets.groupBy("a", "b").agg(F.min("shingles").alias("shingles"), F.min(place).alias("first"), F.count("*").alias("n"))
    items = steps.write(keyed_sets(items.withColumn("item", F.monotonically_increasing_id()), bands, rows, percent), n)
    member = steps.write(spots.join(items.select("a", "b", "item"), ["a", "b"]).drop("a", "b"), n)
    posts = items.select("item", F.explode("keys").alias("key"), F.col("n").alias("weight"))
    steps.drop(met, sets)

    def verify(found: DataFrame) -> DataFrame:
        left = items.select(F.col("item").alias("a"), F.col("shingles").alias("x"))
        right = items.select(F.col("item").alias("b"), F.col("shingles").alias("y"))
        shared = F.size(F.array_intersect("x", "y"))
        both = found.join(left, "a").join(right, "b")
        return both.filter(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b")

    # in the join itself, under the first key that both have: only pairs that hold leave it
    both = F.size(F.array_intersect("x.shingles", "y.shingles"))
    near_sizes = 100 * F.least("x.size", "y.size") >= percent * F.greatest("x.size", "y.size")
    first_key = F.element_at(F.array_intersect("x.keys", "y.keys"), 1) == F.col("x.key")
    fits = near_sizes & first_key & (100 * both >= percent * (F.col("x.size") + F.col("y.size") - both))
    known = items.select("item", "shingles", F.size("shingles").alias("size"), "keys")
    group = bucket_components(posts, verify, steps, known, fits, SPLIT)
    named = items.select("item", "first").join(group, "item", "left").withColumn("component", F.coalesce("component", "item"))
    origin = named.groupBy("component").agg(F.min("first").alias("kept"))
    origin = steps.write(named.select("item", "component").join(origin, "component").select("item", "kept"), n)
    later = member.join(origin, "item").withColumn("place", place).filter("place <> kept")
    # places of one document only: as many as its paragraphs
    text = W.partitionBy("doc_id", "version")
    run = F.col("pos") - F.row_number().over(text.orderBy("pos"))
    found = later.withColumn("run", run).groupBy("doc_id", "version", "run").agg(
        F.min("place").alias("low"), F.max("place").alias("high"), F.min_by("kept", "pos").alias("low_kept"), F.max_by("kept", "pos").alias("high_kept"),
        F.min("word").alias("word"), F.max(F.col("word") + F.col("n_words")).alias("stop"), F.min("begin").alias("begin"), F.max("finish").alias("finish"),
    )
    found = _extended(steps.write(found.drop("run"), n), docs, steps, reach)
    # runs that have grown into one another are one passage
    upto = F.max("stop").over(text.orderBy("word", "stop").rowsBetween(W.unboundedPreceding, -1))
    found = found.withColumn("new", F.coalesce(F.col("word") > upto, F.lit(True)).cast("int"))
    found = found.withColumn("passage", F.sum("new").over(text.orderBy("word", "stop").rowsBetween(W.unboundedPreceding, 0)))
    found = found.groupBy("doc_id", "version", "passage").agg(
        F.min("begin").alias("start_char"), F.max("finish").alias("to_char"), F.min("word").alias("word"), F.max("stop").alias("stop"), F.min_by("low_kept", "word").alias("kept")
    )
    found = found.withColumn("n_words", F.col("stop") - F.col("word")).filter(F.col("n_words") >= min_words)
    return found.select("doc_id", "version", "start_char", (F.col("to_char") - F.col("start_char")).alias("n_chars"), "n_words", F.col("kept.doc_id").alias("kept_doc_id"))


def without_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the passages (doc_id, version, start_char, n_chars) cut out of ``text``. White space around them stays."""
    cuts = passages.groupBy("doc_id", "version").agg(F.sort_array(F.collect_list(F.struct("start_char", "n_chars"))).alias("_cuts"))
    cuts = cuts.withColumnsRenamed({"doc_id": "_id", "version": "_version"})
    rows = docs.join(cuts, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_version")), "left")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("_cuts", lambda c: c["start_char"] + c["n_chars"]))
    ends = F.concat(F.transform("_cuts", lambda c: c["start_char"]), F.array(F.length("text").cast("long")))
    left = F.zip_with(begins, ends, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    return rows.withColumn("text", F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(F.array_join(left, ""))).select(*docs.columns)
