"""State sequences, word pairs and hidden-state decoding."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import durable
from .joins import join_hot
from .ordered import Ordered, ordered

START, END = "<s>", "</s>"
#: Numbers that a decoding task lays out at a time.
CELLS = 1 << 20


def tokens(text):
    """Lower-case words between a start and an end mark."""
    return F.concat(F.array(F.lit(START)), F.split(F.lower(F.trim(text)), r"\s+"), F.array(F.lit(END)))


def transitions(df: DataFrame, keys: list[str], order: str, state: str, tie: str | None = None) -> DataFrame:
    """(state, next, n, p): counts and shares of the steps between neighbouring rows of a key."""
    step = ordered(df, Ordered(order=order, keys=keys, tie=[tie] if tie else [], lead={"next": state})).filter("next is not null")
    counts = step.groupBy(F.col(state).alias("state"), "next").agg(F.count(F.lit(1)).alias("n"))
    out = counts.groupBy("state").agg(F.sum("n").alias("_out"))
    return counts.join(out, "state").select("state", "next", "n", (F.col("n") / F.col("_out")).alias("p"))


def stationary(steps: DataFrame, tolerance: float = 1e-12, every: int = 5, rounds: int = 2000) -> DataFrame:
    """The distribution that the steps leave unchanged, by repeated half steps from the uniform one.

    Half of the mass stays where it is in every round, so a chain that swings between groups of states
    settles too, on the same distribution. A state without a way out keeps its mass; a state that nothing
    enters ends with none and stays in the result. Works on tables, so the number of states may be large; every few rounds the
    current distribution is written out, which cuts the lineage and gives the change to compare
    with ``tolerance``. Raises if it is not met after ``rounds``.
    """
    steps = durable(steps.select("state", "next", "p"))
    states = durable(steps.select("state").union(steps.select("next")).distinct())
    ends = states.join(steps.select("state").distinct(), "state", "left_anti")
    stay = ends.select("state", F.col("state").alias("next"), F.lit(1.0).alias("p"))
    half = steps.union(stay).select("state", "next", (F.col("p") / 2).alias("p"))
    steps = durable(half.union(states.select("state", F.col("state").alias("next"), F.lit(0.5).alias("p"))))
    pi = states.withColumn("pi", F.lit(1.0 / max(1, states.count())))
    for i in range(1, rounds + 1):
        last = pi
        pi = steps.join(pi, "state").groupBy(F.col("next").alias("state")).agg(F.sum(F.col("pi") * F.col("p")).alias("pi"))
        if i % every == 0:
            gap = pi.join(last.withColumnRenamed("pi", "old"), "state").select("state", "pi", F.abs(F.col("pi") - F.col("old")).alias("gap"))
            gap = durable(gap)
            pi = gap.select("state", "pi")
            worst = gap.agg(F.max("gap")).head()[0]
            if worst is None or worst < tolerance:
                return pi
    raise RuntimeError(f"not settled after {rounds} rounds")


def pair_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per neighbouring token pair of every text."""
    # The tokens are bound to a name inside the lambda, so a text is split once.
    pairs = F.transform(
        F.array(tokens(F.col(text))),
        lambda t: F.zip_with(
            F.slice(t, F.lit(1), F.size(t) - 1), F.slice(t, F.lit(2), F.size(t) - 1), lambda a, b: F.struct(a.alias("prev"), b.alias("cur"))
        ),
    )
    return df.select(*keep, text).select(*keep, F.inline(pairs[0]))


def unigrams(df: DataFrame, text: str) -> DataFrame:
    return df.select(text).select(F.explode(tokens(F.col(text))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def bigrams(df: DataFrame, text: str) -> DataFrame:
    return pair_rows(df, text).groupBy("prev", "cur").agg(F.count(F.lit(1)).alias("n"))


def vocabulary_size(uni: DataFrame):
    """Distinct tokens without the start mark, as a scalar."""
    return uni.agg(F.count_if(F.col("token") != START)).scalar()


def smoothed(count, context, alpha: float, size):
    return (F.coalesce(count, F.lit(0)) + alpha) / (F.coalesce(context, F.lit(0)) + alpha * size)


def perplexity(model: DataFrame, model_text: str, df: DataFrame, key: str, text: str, alpha: float = 0.5) -> DataFrame:
    """Log-probability and perplexity of every text under the pair counts of ``model``.

    Each text is reduced to its distinct pairs with counts, and of the model's counts only the pairs that
    some text asks for are kept.
    """
    rows = pair_rows(df, text, key).groupBy(key, "prev", "cur").agg(F.count(F.lit(1)).alias("_k"))
    wanted = rows.select("prev", "cur").distinct()
    # pairs are counted where they are read, and only the counts are shuffled to the join
    bi = bigrams(model, model_text).join(wanted, ["prev", "cur"], "left_semi")
    uni = unigrams(model, model_text)
    seen = rows.join(bi, ["prev", "cur"], "left").join(
        uni.select(F.col("token").alias("prev"), F.col("n").alias("context")), "prev", "left"
    )
    logp = F.ln(smoothed(F.col("n"), F.col("context"), alpha, F.col("_size")))
    scored = seen.withColumn("_size", vocabulary_size(uni)).withColumn("_lp", logp * F.col("_k"))
    total = scored.groupBy(key).agg(F.sum("_lp").alias("log_probability"), F.sum("_k").alias("n_pairs"))
    return total.withColumn("perplexity", F.exp(-F.col("log_probability") / F.col("n_pairs")))


def word_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """(keep, at, word): every word of a text, in lower case, with its place from 0."""
    return df.select(*keep, F.posexplode(F.split(F.lower(F.trim(F.col(text))), r"\s+")).alias("at", "word"))


def hmm_tables(df: DataFrame, seq: str, order: str, word: str, tag: str, alpha: float = 0.1, tie: list[str] | None = None, max_tags: int = 256):
    """Smoothed start, transition and emission tables of tagged rows, with one slot for unknown words.

    Rows of a sequence are taken by ``order`` and ``tie``. Returns (start, transition, emission, tag list). The tag list is the only thing
    collected; the model has a number for every pair of tags, so more than ``max_tags`` are refused.
    """
    tie = tie or []
    rows = df.select(seq, order, *tie, F.col(word).alias("word"), F.col(tag).alias("tag"))
    tag_counts = rows.groupBy("tag").agg(F.count(F.lit(1)).alias("tag_n"))
    tags = sorted(r.tag for r in tag_counts.select("tag").limit(max_tags + 1).collect())
    if len(tags) > max_tags:
        raise ValueError(f"more than {max_tags} tags")
    k = float(len(tags))
    spark = df.sparkSession
    grid = spark.createDataFrame([(t,) for t in tags], "tag string")

    placed = ordered(rows, Ordered(order=order, keys=[seq], tie=tie, lag={"prev": "tag"}))
    starts = placed.filter("prev is null").groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    n_seq = starts.agg(F.sum("n")).scalar()
    start = grid.join(starts, "tag", "left").select("tag", ((F.coalesce("n", F.lit(0)) + alpha) / (n_seq + alpha * k)).alias("p"))

    steps = placed.filter("prev is not null").groupBy("prev", "tag").agg(F.count(F.lit(1)).alias("n"))
    outgoing = steps.groupBy("prev").agg(F.sum("n").alias("out_n"))
    both = grid.withColumnRenamed("tag", "prev").withColumn("tag", F.explode(F.array(*[F.lit(t) for t in tags])))
    transition = (
        both.join(steps, ["prev", "tag"], "left")
        .join(outgoing, "prev", "left")
        .select("prev", "tag", smoothed(F.col("n"), F.col("out_n"), alpha, F.lit(k)).alias("p"))
    )

    emitted = rows.groupBy("tag", "word").agg(F.count(F.lit(1)).alias("n"))
    words = emitted.agg(F.count_distinct("word")).scalar()
    emission = emitted.join(tag_counts, "tag").select(
        "tag", "word", ((F.col("n") + alpha) / (F.col("tag_n") + alpha * (words + 1))).alias("p")
    )
    unknown = tag_counts.select("tag", F.lit(None).cast("string").alias("word"), (alpha / (F.col("tag_n") + alpha * (words + 1))).alias("p"))
    return start, transition, emission.union(unknown), tags


def _stacked(blocks: pd.Series, width: int):
    """(values, lengths): blocks of steps, ``width`` numbers each, side by side, shorter ones filled up at the end."""
    lengths = np.array([len(b) // width for b in blocks])
    out = np.zeros((len(blocks), lengths.max(initial=0), width))
    for i, b in enumerate(blocks):
        out[i, : lengths[i]] = np.reshape(b, (-1, width))
    return out, lengths


def _few(blocks: pd.Series, least: int):
    """Places of blocks of about equal length, as many at a time as have ``CELLS`` numbers filled up, ``least`` each at least; one always."""
    sizes = np.array([len(b) for b in blocks])
    order, lo = np.argsort(sizes, kind="stable"), 0
    while lo < len(order):
        cells = np.arange(1, len(order) - lo + 1) * np.maximum(sizes[order[lo:]], least)
        hi = lo + max(1, int(np.searchsorted(cells, CELLS, "right")))
        yield order[lo:hi]
        lo = hi


def _matrices(values: np.ndarray, t: int, first: np.ndarray, model) -> np.ndarray:
    """The (max, +) matrices of step ``t`` of all blocks, from the emissions of its word or, on higher levels, as stored."""
    if model is None:
        k = math.isqrt(values.shape[2])
        return values[:, t].reshape(-1, k, k)
    start, step = model
    lead = np.where((first & (t == 0))[:, None, None], start[None, None, :], step[None])
    return lead + values[:, t][:, None, :]


def _product_udf(k: int, model):
    """Best score from every entry state to every exit state over a block of steps."""
    width = k if model is not None else k * k

    def scores(begins: np.ndarray, steps: pd.Series) -> np.ndarray:
        values, lengths = _stacked(steps, width)
        total = _matrices(values, 0, begins, model).copy()
        for t in range(1, values.shape[1]):
            on = lengths > t
            m = _matrices(values[on], t, begins[on], model)
            total[on] = np.max(total[on][:, :, :, None] + m[:, None, :, :], axis=2)
        return total.reshape(len(total), -1)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def best_scores(first: pd.Series, steps: pd.Series) -> pd.Series:
        begins, out = first.to_numpy(dtype=bool), np.zeros((len(steps), k * k))
        for few in _few(steps, k * k * k):
            out[few] = scores(begins[few], steps.iloc[few])
        return pd.Series(list(out))

    return best_scores


def _path_udf(k: int, model):
    """The exit state of every step on the best path that enters a block in one state and leaves it in another."""
    width = k if model is not None else k * k

    def paths(begins: np.ndarray, entry: np.ndarray, leave: np.ndarray, steps: pd.Series) -> list[list[int]]:
        values, lengths = _stacked(steps, width)
        n = len(steps)
        score = np.full((n, k), -np.inf)
        score[np.arange(n), entry] = 0.0
        back = np.zeros((n, values.shape[1], k), np.int32)
        for t in range(values.shape[1]):
            on = lengths > t
            ways = score[on][:, :, None] + _matrices(values[on], t, begins[on], model)
            back[on, t] = ways.argmax(axis=1)
            score[on] = ways.max(axis=1)
        out = []
        for i, j in enumerate(leave):
            path = [int(j)]
            for t in range(lengths[i] - 1, 0, -1):
                path.append(int(back[i, t, path[-1]]))
            out.append(path[::-1])
        return out

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def best_path(first: pd.Series, entry: pd.Series, leave: pd.Series, steps: pd.Series) -> pd.Series:
        begins, enter, end = first.to_numpy(dtype=bool), entry.to_numpy(dtype=int), leave.to_numpy(dtype=int)
        out: list = [None] * len(steps)
        for few in _few(steps, k * k):
            for i, path in zip(few, paths(begins[few], enter[few], end[few], steps.iloc[few])):
                out[i] = np.array(path, np.int32)
        return pd.Series(out)

    return best_path


def decode(df: DataFrame, seq: str, order: str, word: str, tables, block: int = 1024, tie: list[str] | None = None) -> DataFrame:
    """The most probable tag of every row of every sequence: (seq, order, tie, tag).

    The best score over a run of steps is a product in (max, +), which may be grouped freely. A row carries the k
    emission scores of its word, found in a dictionary by a join; the k * k matrix of a step is made where its block is worked on. Steps
    are multiplied in blocks of ``block``, blocks in blocks of blocks, until a sequence is one block;
    then the best path is fixed from the top down. No task ever holds more than one Arrow batch of blocks, and lays out ``CELLS`` numbers of it at a time.
    """
    start, transition, emission, tags = tables
    tie, k = tie or [], len(tags)
    if not k:
        return df.select(seq, order, *tie, F.lit(None).cast("string").alias("tag")).limit(0)
    # k and k*k numbers, k is limited by hmm_tables
    s = {r.tag: r.p for r in start.collect()}
    a = {(r.prev, r.tag): r.p for r in transition.collect()}
    model = np.log([s[v] for v in tags]), np.log([[a[u, v] for v in tags] for u in tags])
    unknown = {r.tag: float(np.log(r.p)) for r in emission.filter("word is null").collect()}

    per_word = emission.filter("word is not null").groupBy("word").agg(
        F.array(*[F.coalesce(F.max(F.when(F.col("tag") == t, F.ln("p"))), F.lit(unknown[t])) for t in tags]).alias("e")
    )
    numbered = ordered(df.select(seq, order, *tie, F.col(word).alias("word")), Ordered(order=order, keys=[seq], tie=tie, row_number="_n"))
    rows = join_hot(numbered, per_word, "word", "left")
    never = F.array(*[F.lit(unknown[t]) for t in tags])
    leaf = rows.select(seq, order, *tie, (F.col("_n") - 1).alias("_pos"), F.coalesce("e", never).alias("_m"))

    def grouped(level: DataFrame) -> DataFrame:
        blocks = level.groupBy(seq, F.expr(f"_pos div {block}").alias("_block")).agg(
            F.array_sort(F.collect_list(F.struct("_pos", "_m"))).alias("_s")
        )
        # side by side in one array: an array for each step would take many times its numbers in a Python task
        return blocks.select(seq, "_block", F.flatten(F.transform("_s", lambda x: x["_m"])).alias("_steps"))

    levels = [durable(leaf)]
    longest = levels[0].agg(F.max("_pos")).head()[0]
    longest = 0 if longest is None else longest
    tops = []
    begins = F.col("_block") == 0
    while True:
        kind = model if len(levels) == 1 else None
        up = durable(grouped(levels[-1]))
        tops.append((up, kind))
        longest //= block
        top = up.select(seq, F.col("_block").alias("_pos"), _product_udf(k, kind)(begins, "_steps").alias("_m"))
        if longest == 0:
            break
        levels.append(durable(top))

    # At the top a sequence is one product; its best exit is the best end of the whole path.
    best = F.array_position("_m", F.array_max("_m")) - 1
    ends = top.select(seq, F.col("_pos").alias("_block"), (best.cast("int") / F.lit(k)).cast("int").alias("_i"), (best % k).cast("int").alias("_j"))
    for up, kind in reversed(tops):
        chosen = up.join(ends, [seq, "_block"]).select(seq, "_block", "_i", _path_udf(k, kind)(begins, "_i", "_j", "_steps").alias("_path"))
        each = chosen.select(seq, "_block", F.col("_i").alias("_enter"), "_path", F.posexplode("_path").alias("_at", "_j"))
        enter = F.when(F.col("_at") == 0, F.col("_enter")).otherwise(F.col("_path")[F.col("_at") - 1])
        ends = each.select(seq, (F.col("_block") * block + F.col("_at")).alias("_block"), enter.alias("_i"), "_j")
    names = F.array(*[F.lit(t) for t in tags])
    answer = ends.select(seq, F.col("_block").alias("_pos"), names[F.col("_j")].alias("tag"))
    return levels[0].select(seq, order, *tie, "_pos").join(answer, [seq, "_pos"]).select(seq, order, *tie, "tag")
