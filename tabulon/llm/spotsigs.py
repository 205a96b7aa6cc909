"""Document fingerprints by SpotSigs, in DataFrame functions only.

Common-word anchors mark the running text of a document. Each anchor with the chain of the next ``CHAIN``
content words gives a signature; the set of signatures is the fingerprint. Fingerprints are compared by
Jaccard similarity: sets fall into partitions by length, so that only sets whose lengths allow the
threshold meet, they meet only on their rarest signatures, and the size bound is tried before the sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import bucket_components
from .steps import Steps, partitions

CHAIN = 2
REACH = 10
LIKENESS = 0.8

#: Anchors are articles and forms of "is" in four languages, the rest are common words that are no content.
ANCHORS = "a an the is that der die das ist ein eine le la les est un une el los las es una".split()
COMMON = (
    "of and to in for on with by this from be are was it as or at not but have has had they he she we you i "
    "und zu den von mit für auf sich im dem nicht auch als an aus bei des "
    "de et que pour dans en du au des sur pas par qui ne ce "
    "y del por con para se su lo al como más"
).split()


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def signatures(text: Column) -> Column:
    """The sorted distinct signatures of a text, 32 bits each.

    A chain looks at most ``REACH`` words ahead. A text with words but no chain has one signature of all its words, a text without
    words one of its characters; null and empty texts have none.
    """
    text = F.coalesce(text, F.lit(""))

    def spots(words: Column) -> Column:
        def chain(word: Column, i: Column) -> Column:
            ahead = F.filter(F.slice(words, i + 2, REACH), lambda w: ~w.isin(ANCHORS + COMMON))
            found = _let(ahead, lambda c: F.when(F.size(c) >= CHAIN, F.hash(word, *[F.get(c, F.lit(k)) for k in range(CHAIN)])))
            return F.when(word.isin(ANCHORS), found)

        whole = F.when(F.size(words) > 0, F.hash(F.array_join(words, " "))).when(text != "", F.hash(text))
        return _let(F.array_compact(F.transform(words, chain)), lambda s: F.when(F.size(s) > 0, s).otherwise(F.array_compact(F.array(whole))))

    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_sort(F.array_distinct(_let(words, spots)))


def as_text(signature_set: Column) -> Column:
    """A fingerprint as text: eight hex digits per signature, in order."""
    return F.array_join(F.transform(signature_set, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), "")


def likeness(x: Column, y: Column) -> Column:
    """Jaccard similarity of two signature sets; two empty sets are alike (1), an empty and another are not (0)."""
    both = F.when((F.size(x) == 0) | (F.size(y) == 0), 0).otherwise(F.size(F.array_intersect(x, y)))
    union = F.size(x) + F.size(y) - both
    return F.when(union == 0, 1.0).otherwise(both / F.nullif(union, F.lit(0)))


def with_next(docs: DataFrame, columns: list[str], tie: list[str]) -> DataFrame:
    """Adds next: a struct of ``columns`` of the next row by descending doc_id, of the first row after the last.

    Null ids come last; equal ids follow in the order of ``tie``. Rows are cut at quantiles of doc_id into about four ranges per
    shuffle partition. The first rows of a range are sent along to the range before it as guests, so one shuffle is enough.
    """
    n = 4 * partitions(docs.sparkSession)
    shares = ",".join(repr(i / n) for i in range(1, n))
    row = docs.select(F.max("doc_id").alias("top"), F.expr(f"approx_percentile(doc_id, array({shares}), {10 * n})").alias("cuts")).first()
    cuts = sorted({row["top"], *row["cuts"]}, reverse=True) if row["top"] is not None else [None]
    if row["top"] is None:
        return _lead(docs.withColumn("_range", F.lit(0)).withColumn("_guest", F.lit(False)), columns, tie, wrap=True)
    points = F.array(*[F.lit(int(c)) for c in cuts])
    powers = [1 << k for k in range(len(cuts).bit_length() - 1, -1, -1)]
    spot = F.aggregate(  # how many cuts are not below the id: a binary search
        F.array(*[F.lit(p) for p in powers]),
        F.lit(0),
        lambda at, step: F.when((at + step <= len(cuts)) & (F.col("doc_id") <= F.get(points, F.least(at + step, F.lit(len(cuts))) - 1)), at + step).otherwise(at),
    )
    place = F.coalesce(F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(spot), F.lit(len(cuts)))
    rows = docs.withColumn("_range", place)
    opens = F.coalesce(F.col("doc_id") == F.get(points, F.col("_range") - 1), F.lit(False))
    before = F.when(F.col("_range") > 1, F.col("_range") - 1).otherwise(F.lit(len(cuts)))
    seats = F.when(opens, F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("g")), F.struct(before.alias("r"), F.lit(True).alias("g"))))
    seats = seats.otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("g"))))
    rows = rows.withColumn("_seat", F.explode(seats)).withColumns({"_range": F.col("_seat.r"), "_guest": F.col("_seat.g")}).drop("_seat")
    return _lead(rows, columns, tie, wrap=False)


def _lead(rows: DataFrame, columns: list[str], tie: list[str], wrap: bool) -> DataFrame:
    order = W.partitionBy("_range").orderBy("_guest", F.col("doc_id").desc_nulls_last(), *tie)
    following = F.lead(F.struct(*columns)).over(order)
    if wrap:  # no row has an id: the few that a table can hold this way are one range
        following = F.coalesce(following, F.first(F.struct(*columns)).over(order))
    return rows.withColumn("next", following).filter("not _guest").drop("_range", "_guest")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, own, edited, near_edited, near_next) of every row of ``docs`` (doc_id, text).

    ``own`` and ``edited`` are signature sets. The edited text has its last floor(n_chars / 2) code points replaced
    by the first as many of the next document (descending doc_id; the first follows the last), or by all it has.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs.withColumn("own", signatures(F.col("text"))).withColumn("tie", F.xxhash64("text")), ["text", "own"], ["tie"])
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.col("next.text"), F.lit(1), half))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "own", F.col("next.own").alias("following"), edited.alias("changed"))
    rows = rows.withColumn("edited", signatures(F.col("changed"))).withColumn("edited_sha256", F.sha2(F.col("changed").cast("binary"), 256))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "own", "edited",
        likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def classes(prints: DataFrame, steps: Steps, least: float = LIKENESS) -> DataFrame:
    """(a, b, class_id): for every non-empty fingerprint (two hashes of the set) the smallest doc_id whose fingerprint it
    reaches over links of likeness ``least`` or more. ``prints``: doc_id, own."""
    keyed = prints.filter("size(own) > 0 and doc_id is not null").select("doc_id", "own", F.xxhash64("own").alias("a"), F.xxhash64(F.lit(1), "own").alias("b"))
    items = steps.write(keyed.groupBy("a", "b").agg(F.min("doc_id").alias("class_id"), F.min("own").alias("own")).withColumn("item", F.monotonically_increasing_id()))
    spots = items.select("item", F.size("own").alias("n"), F.explode("own").alias("spot"))
    shared = spots.groupBy("spot").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = spots.join(shared, "spot").groupBy("item").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "spot"))).alias("spots"))
    # signatures of no other set come first in the order and cannot match; the prefix is what they leave of it
    skip = F.col("n") - F.size("spots")
    prefix = F.slice("spots", 1, F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * least).cast("int") + 1 - skip))
    part = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / least)).cast("int")
    shelves = F.array(part, part + 1)
    keys = F.flatten(F.transform(shelves, lambda shelf: F.transform("prefix", lambda spot: F.xxhash64(shelf, spot))))
    ranked = ranked.select("item", "n", F.size("spots").alias("shared"), F.transform(prefix, lambda p: p["spot"]).alias("prefix"))
    known = steps.write(ranked.filter(F.col("shared") >= least * F.col("n")).select("item", "n", "shared", keys.alias("keys")))
    posts = known.select("item", F.col("shared").alias("weight"), F.explode("keys").alias("key"))

    def verify(found: DataFrame) -> DataFrame:
        left = items.select(F.col("item").alias("a"), F.col("own").alias("x"))
        right = items.select(F.col("item").alias("b"), F.col("own").alias("y"))
        both = found.join(left, "a").join(right, "b")
        bound = F.least(F.size("x"), F.size("y")) >= least * F.greatest(F.size("x"), F.size("y"))
        return both.filter(bound).filter(likeness(F.col("x"), F.col("y")) >= least).select("a", "b")

    # no more can be common than either set has in common with any other
    most = F.least("x.shared", "y.shared")
    fits = (most >= least * (F.col("x.n") + F.col("y.n") - most)) & (F.element_at(F.array_intersect("x.keys", "y.keys"), 1) == F.col("x.key"))
    # then the sets themselves, in the join: only pairs that hold leave it
    fits = fits & (likeness(F.col("x.own"), F.col("y.own")) >= least)
    group = bucket_components(posts, verify, steps, known.join(items.select("item", "own"), "item"), fits)
    placed = items.select("a", "b", "item", "class_id").join(group, "item", "left").withColumn("component", F.coalesce("component", "item"))
    lowest = placed.groupBy("component").agg(F.min("class_id").alias("class_id"))
    return steps.write(placed.drop("class_id").join(lowest, "component").select("a", "b", "class_id"))


def fingerprint_documents(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """``fingerprints`` with the sets as texts, and class_id: the smallest doc_id of the documents alike by ``least`` or more,
    over others too. Empty fingerprints are alone in their class; a null doc_id has a null class unless its fingerprint has others."""
    steps = Steps(docs.sparkSession, "spots")
    prints = steps.write(fingerprints(docs))
    group = classes(prints.select("doc_id", "own"), steps, least)
    rows = prints.withColumns({"a": F.xxhash64("own"), "b": F.xxhash64(F.lit(1), "own")}).join(group, ["a", "b"], "left")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"),
        "near_edited", "near_next", F.coalesce("class_id", "doc_id").alias("class_id"),
    )
