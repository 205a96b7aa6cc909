"""Conversation structure repair: the cheapest edits by the auction shortest-path algorithm.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``. The lattice has one node per (rows read,
state of that pattern); its arcs are the edits with integer costs: Keep, Rerole, Delete, Insert. Every node has a price. A path grows
from the start: at its last node the price is raised to the cheapest arc plus the price behind it and the path steps back
(contraction), or, where price and arc agree, it steps on (extension). Prices never exceed an arc's cost plus the price behind it; when the path
meets the end, the arcs of every cheapest path hold with equality. The edits are then read off these
tight arcs, always the least letter that still leads to the end.

Rows lie in blocks of at most ``BLOCK``. Blocks of a conversation are priced from the last to the first, each ends in
the prices of the one after it, so the work grows with the rows and a task holds one block, however long a conversation is.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .steps import Steps, partitions

DELETE, INSERT, REROLE = 4, 3, 3
TRUNCATED = 3
#: Rows of a block, as a power of two.
BITS = 5
BLOCK = 1 << BITS
BLANKS = "\\x20\\x09-\\x0D"
#: States of the pattern: nothing yet, after s, after u, after a; a conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
OPEN = -1  # no end in this state
END = (0, OPEN, OPEN, 0)
#: The state behind a kept row, by state and initial; user and assistant rows are also what an insertion or a new role may give.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}


def _edits(kind: str, state: int):
    """(letter, cost, state after) of the edits of one row. ``kind``: d for a row that has to go, else the role's initial (x for
    any other), upper case for a truncated row."""
    out = [("D", DELETE, state)]
    if kind != "d":
        more = TRUNCATED if kind.isupper() else 0
        after = STEP.get((state, kind.lower()))
        if after is not None:
            out.append(("K", more, after))
        out.append(("R", REROLE + more, NEXT[state]))
    return out


def prices(kinds: str, ends: tuple[int, ...]) -> tuple[int, ...]:
    """Prices of the nodes (row, state) of one block at ``4 * row + state``, so that those of the first row are the costs to the end.

    ``ends`` has the cost from each state behind the block to the end, ``OPEN`` where there is none.
    """
    n = len(kinds)
    goal = 4 * (n + 1)
    arcs = [[(c, 4 * (i + 1) + q) for _, c, q in _edits(kinds[i], s)] if i < n else [] for i in range(n + 1) for s in range(4)]
    for i in range(n + 1):
        for s in range(4):
            arcs[4 * i + s].append((INSERT, 4 * i + NEXT[s]))
    for s, end in enumerate(ends):
        if end != OPEN:
            arcs[4 * n + s].append((end, goal))
    # prices to begin with: the least that the rows ahead cost in any state, and the least end
    least = [min(e for e in ends if e != OPEN)]
    for kind in reversed(kinds):
        least.append(least[-1] + (DELETE if kind == "d" else TRUNCATED if kind.isupper() else 0))
    price = [p for p in reversed(least) for _ in range(4)] + [0]
    for start in range(4):
        path = [start]
        while path[-1] != goal:
            here = path[-1]
            best, to = min([(cost + price[j], j) for cost, j in arcs[here]])
            if price[here] < best:
                price[here] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
    return tuple(price)


def trace(kinds: str, ends: tuple[int, ...], price: tuple[int, ...], state: int) -> str:
    """The letters of the cheapest edits of a block from ``state``, of equal ones the least in ASCII order."""
    n = len(kinds)
    ready = [[False] * 4 for _ in range(n + 1)]
    ready[n] = [e != OPEN and price[4 * n + s] == e for s, e in enumerate(ends)]

    def ways(i, s):
        here = price[4 * i + s]
        if i < n:
            for letter, cost, after in _edits(kinds[i], s):
                if here == cost + price[4 * (i + 1) + after]:
                    yield letter, i + 1, after
        if here == INSERT + price[4 * i + NEXT[s]]:
            yield "I", i, NEXT[s]

    for i in range(n, -1, -1):
        for _ in range(4):  # insertions stay in the row; no more than three follow one another
            for s in range(4):
                ready[i][s] = ready[i][s] or any(ready[j][q] for _, j, q in ways(i, s))
    out, i = [], 0
    while i < n or not (ends[state] != OPEN and price[4 * n + state] == ends[state]):
        letter, i, state = min(w for w in ways(i, state) if ready[w[1]][w[2]])
        out.append(letter)
    return "".join(out)


class Solved:
    """Blocks already priced and traced in this task; equal blocks with equal ends are solved once. Of bounded size."""

    def __init__(self, room: int = 1 << 13):
        self.room, self.known = room, {}

    def _get(self, key, make):
        if key not in self.known:
            if len(self.known) >= self.room:
                self.known.clear()
            self.known[key] = make()
        return self.known[key]

    def prices(self, kinds: str, ends: tuple[int, ...]) -> tuple[int, ...]:
        # equal up to a constant: the ends are taken less their least, which comes on top again
        base = min(e for e in ends if e != OPEN)
        rest = tuple(e if e == OPEN else e - base for e in ends)
        found = self._get((kinds, rest), lambda: prices(kinds, rest))
        return tuple(p + base for p in found[:4])

    def trace(self, kinds: str, ends: tuple[int, ...], state: int) -> str:
        base = min(e for e in ends if e != OPEN)
        rest = tuple(e if e == OPEN else e - base for e in ends)
        found = self._get((kinds, rest), lambda: prices(kinds, rest))
        return self._get((kinds, rest, state), lambda: trace(kinds, rest, found, state))


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by crc32("conv_id:turn") % 20, nulls in it and in role and text as one blank."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("fault"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text")
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role, text, (F.col("fault") == 0).alias("gone"), copies.alias("copy")).drop("copy")


def _faults(rows: DataFrame, steps: Steps) -> DataFrame:
    """Rows with their place in the order (``seq``), their fault and the kind that ``_edits`` takes."""
    digest = F.sha2(F.concat_ws(":", F.length("role").cast("string"), F.concat("role", "text")), 256)
    rows = steps.write(rows.withColumns({"digest": digest, "id": F.monotonically_increasing_id()}))
    place = F.struct(F.col("turn").isNotNull(), "turn", "id")
    seen = rows.filter("not gone").groupBy("conv_id", "digest").agg(F.min(place).alias("p"), F.count("*").alias("c")).filter("c > 1")
    seen = seen.select(F.col("conv_id").alias("conv2"), F.col("digest").alias("digest2"), F.col("p.id").alias("first"))
    match = F.col("conv_id").eqNullSafe(F.col("conv2")) & (F.col("digest") == F.col("digest2"))
    rows = rows.join(seen.hint("merge"), match, "left")
    shown = F.regexp_replace("text", f"[{BLANKS}]+\\z", "")
    fault = (
        F.when(shown == "", "blank").when(F.col("id") != F.col("first"), "duplicate").when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated")
    )
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    rows = rows.withColumn("fault", F.when(~F.col("gone"), fault))
    kind = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(initial)).otherwise(initial)
    rows = rows.select("conv_id", "turn", "role", "text", "gone", "fault", F.when(~F.col("gone"), kind).alias("kind"), "digest", "id")
    order = ["conv_id", "turn", "digest", "id"]
    rows = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    return steps.write(rows.drop("digest", "id").withColumn("seq", F.monotonically_increasing_id()))


def _block_ends(rows: DataFrame) -> DataFrame:
    """(conv_id, seq, kinds, ends): every block with its first possible place and the costs from its last row on."""
    kinds = F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("seq", "kind"))), lambda r: r["kind"]))
    blocks = rows.filter("not gone").groupBy("conv_id", F.shiftleft(F.shiftright("seq", BITS), BITS).alias("seq")).agg(kinds.alias("kinds"))

    def work(batches):
        now, ends, solved = object(), END, Solved()
        for batch in batches:
            out = []
            for conv, kinds in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if conv != now:
                    now, ends = conv, END
                out.append(list(ends))
                ends = solved.prices(kinds, ends)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=["conv_id", "seq", "kinds", "ends"])

    placed = blocks.repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", F.desc("seq"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    return placed.select("conv_id", "seq", "kinds").mapInArrow(work, f"conv_id {kind}, seq long, kinds string, ends array<long>")


class _Conversation:
    """Running figures of one conversation; rows and blocks come in order."""

    def __init__(self, conv, solved: Solved):
        self.solved = solved
        self.conv, self.turns, self.low, self.high, self.last = conv, 0, None, None, None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.cost, self.audit, self.state = 0, None, [], START
        self.digest, self.lines, self.letters = hashlib.sha256(), 0, iter("")

    def line(self, role: str, text: str):
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def block(self, kinds: str, ends: tuple[int, ...]):
        self.insert()
        if self.cost is None:
            self.cost = self.solved.prices(kinds, ends)[START]
        letters = self.solved.trace(kinds, ends, self.state)
        self.audit.append(letters)
        self.letters = iter(letters)

    def insert(self) -> str | None:
        """Insertions up to the next letter that takes a row; that letter."""
        for letter in self.letters:
            if letter != "I":
                return letter
            self.state = NEXT[self.state]
            self.line(NAMES[self.state], "")

    def row(self, turn, role: str, text: str, fault):
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        if fault:
            self.faults[fault] += 1
        if self.last is not None:
            self.illegal += self.last + role[:1] not in ("su", "ua", "au")
        self.last = role[:1]
        letter = self.insert()
        if letter == "K":
            self.state = STEP[self.state, role[:1]]
            self.line(role, text)
        elif letter == "R":
            self.state = NEXT[self.state]
            self.line(NAMES[self.state], text)

    def result(self) -> list:
        self.insert()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return [self.conv, gaps, *self.faults.values(), self.illegal, self.cost or 0, "".join(self.audit), self.digest.hexdigest()]


FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text, gone): (conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256).

    Rows are taken by turn, nulls first, of equal turns by a digest of role and text; rows that are ``gone`` only keep their
    conversation in the result. A row's first fault counts: blank, duplicate (role and text stood before in the
    conversation), truncated (its last character other than white space is none of ``.!?``). Keep costs 0, a new role 3, deletion 4 (a must for
    blank and duplicate rows), an inserted row without text 3, a truncated row that stays 3 more. A role that begins
    with none of s, u, a (or is empty) cannot be kept. Rows without a conv_id are one conversation. Without rows the figures are 0, the audit empty and the hash that of the empty
    string. Other columns of ``rows`` are not read.

    A hot conversation's rows are sorted by ranges, its faults are found by aggregates, its blocks of symbols (a byte a row) are priced one after
    another and its rows folded into a running hash in one task, with the memory of a batch: a hash runs over them in order.
    """
    spark = rows.sparkSession
    steps = Steps(spark, "repair")
    rows = _faults(rows.select("conv_id", "turn", "role", "text", "gone"), steps)
    blocks = steps.write(_block_ends(rows))
    # a block's marker stands before its rows
    both = blocks.select("conv_id", "seq", F.lit(0).alias("part"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit(None).cast("string").alias("role"),
        F.col("kinds").alias("text"), F.lit(None).cast("string").alias("fault"), "ends").unionByName(
        rows.select("conv_id", "seq", F.when(F.col("gone"), 2).otherwise(1).alias("part"), "turn", "role", F.when(~F.col("gone"), F.col("text")).alias("text"), "fault", F.lit(None).cast("array<long>").alias("ends")))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def table(done, conv_kind):
        kinds = [conv_kind, *[pa.int64()] * len(FIGURES), pa.string(), pa.string()]
        columns = zip(*done) if done else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", *FIGURES, "audit", "repaired_sha256"])

    def work(batches):
        state, solved = None, Solved()
        for batch in batches:
            conv_kind, done = batch.column(0).type, []
            for conv, _, part, turn, role, text, fault, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != state.conv:
                    if state is not None:
                        done.append(state.result())
                    state = _Conversation(conv, solved)
                if part == 0:
                    state.block(text, tuple(ends))
                elif part == 1:
                    state.row(turn, role, text, fault)
            yield table(done, conv_kind)
        if state is not None:
            yield table([state.result()], conv_kind)

    placed = both.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "seq", "part")
    figures = ", ".join(f"{f} long" for f in FIGURES)
    return placed.mapInArrow(work, f"conv_id {kind}, {figures}, audit string, repaired_sha256 string")
