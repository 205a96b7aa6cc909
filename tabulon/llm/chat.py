"""Chat formatting by token-level assembly.

Role and text of every turn are encoded as segments of their own, and reserved ids are spliced between
them: ``TURN role TEXT text END``. No text can encode to a reserved id, and control strings inside texts are
escaped, so the rendered form is unambiguous too. The loss mask comes from prefix sums over the token stream: the sum of
TURN marks names the turn, TEXT marks less END marks tell whether a token lies in its text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .steps import partitions

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
LEARNED = "assistant"
PIECE = 20_000

#: The marks of this template and of common others. They never stand unescaped in a text.
MARKS = ["<|turn|>", "<|text|>", "<|end|>"]
CONTROL = [*MARKS, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
ESCAPE = "␛"

#: Between a letter and a blank before a letter the pre-splitter of the file always ends a word, so no merge spans that place.
_cut = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")

_control = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.S)


def escape(text: str) -> str:
    """Breaks every control string after its first character; ``unescape`` gives the text back exactly."""
    return _control.sub(lambda m: m[1] + ESCAPE + "c", text.replace(ESCAPE, ESCAPE + "e"))


def unescape(text: str) -> str:
    return text.replace(ESCAPE + "c", "").replace(ESCAPE + "e", ESCAPE)


class Tokens:
    """A byte-level tokenizer file with three reserved ids after its vocabulary. Opened once per worker."""

    _open: dict = {}

    def __init__(self, path: str = MODEL):
        self.path = path

    def model(self):
        if self.path not in Tokens._open:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(self.path)
            model.encode_special_tokens = True  # their strings in a text are ordinary text
            Tokens._open[self.path] = (model, model.get_vocab_size())
        return Tokens._open[self.path]

    def encode(self, text: str) -> list[int]:
        """The ids of the whole text. Long texts are encoded in parts of about ``PIECE`` characters, cut only where
        the ids do not change; a text without such a place is one part."""
        model, _ = self.model()
        out, at = [], 0
        while at < len(text):
            place = _cut.search(text, at + PIECE)
            end = place.start() if place else len(text)
            out += model.encode(text[at:end], add_special_tokens=False).ids
            at = end
        return out

    def decode(self, ids) -> str:
        return self.model()[0].decode(list(ids), skip_special_tokens=False)

    def reserved(self) -> tuple[int, int, int]:
        size = self.model()[1]
        return size, size + 1, size + 2


def loss_mask(ids: np.ndarray, roles: list[str], marks: tuple[int, int, int], learned: str = LEARNED) -> np.ndarray:
    """True for tokens inside texts of the learned role. ``roles`` lists the role of each turn of the stream."""
    turn, text, end = marks
    number = np.cumsum(ids == turn) - 1
    inside = np.cumsum(ids == text) - np.cumsum(ids == end) > 0
    wanted = np.array([r == learned for r in roles] or [False])
    return inside & (ids != text) & wanted[np.maximum(number, 0)]


def format_turns(conversations: DataFrame, tokens: Tokens | None = None, learned: str = LEARNED) -> DataFrame:
    """(conv_id, turn, tie, ids, loss) for every row of ``conversations`` (conv_id, turn, role, text).

    ``ids`` is the row's part of the token stream, ``loss`` its mask; a conversation is its rows in the order of turn
    (null first), then ``tie``, a hash of role and text. Null role and text count as empty; a repeated row is a turn of its own.
    Rows are encoded where they are read, no conversation is gathered.
    """
    tokens = tokens or Tokens()

    def work(batches):
        marks = tokens.reserved()
        turn, text, end = marks
        for batch in batches:
            roles = [r or "" for r in batch.column(3).to_pylist()]
            texts = [t or "" for t in batch.column(4).to_pylist()]
            parts = [[turn, *tokens.encode(escape(r)), text, *tokens.encode(escape(t)), end] for r, t in zip(roles, texts)]
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            ids = np.array([i for p in parts for i in p], np.int32)
            mask = loss_mask(ids, roles, marks, learned)
            lists = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(v)) for v in (ids, mask)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names=["conv_id", "turn", "tie", "ids", "loss"])

    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.xxhash64("role", "text").alias("tie"), "role", "text")
    return rows.mapInArrow(work, "conv_id long, turn long, tie long, ids array<int>, loss array<boolean>")


def render(turns: DataFrame, tokens: Tokens | None = None) -> DataFrame:
    """Adds formatted: the text that a row of ``format_turns`` stands for, marks included and control strings escaped."""
    tokens = tokens or Tokens()
    at = turns.columns.index("ids")

    def work(batches):
        names = dict(zip(tokens.reserved(), MARKS))
        for batch in batches:
            texts = []
            for ids in batch.column(at).to_pylist():
                out, run = [], []
                for i in ids:
                    if i in names:
                        out += [tokens.decode(run), names[i]]
                        run = []
                    else:
                        run.append(i)
                texts.append("".join(out) + tokens.decode(run))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "formatted"])

    return turns.mapInArrow(work, T.StructType([*turns.schema.fields, T.StructField("formatted", T.StringType())]))


def read_back(turns: DataFrame, tokens: Tokens | None = None) -> DataFrame:
    """One row per conversation, read from the token streams alone: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars).

    Rows meet by conversation, sorted, and are folded one after another into running digests, so a
    conversation of any length needs the memory of one batch. Digests run over a whole conversation in order, so one
    conversation is one task's work.
    """
    tokens = tokens or Tokens()

    def work(batches):
        turn, text, end = tokens.reserved()
        width = sum(map(len, MARKS))
        now, state = object(), None

        def row():
            n, turns_digest, chars, loss_digest, formatted = state
            return [now, n, turns_digest.hexdigest(), chars, loss_digest.hexdigest(), formatted]

        for batch in batches:
            done = []
            for conv, ids, loss in zip(batch.column(0).to_pylist(), batch.column(3), batch.column(4)):
                if state is None or conv != now:
                    if state is not None:
                        done.append(row())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = ids.values.to_numpy()
                mask = loss.values.to_numpy(zero_copy_only=False)
                cut = int(np.flatnonzero(ids == text)[0])
                role, said = tokens.decode(ids[1:cut]), tokens.decode(ids[cut + 1 : -1])
                state[0] += 1
                state[1].update(f"{unescape(role)}\n{unescape(said)}\n".encode())
                learned = unescape(tokens.decode(ids[mask])) if mask.any() else ""
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(role) + len(said) + width
            if done:
                yield _table(done)
        if state is not None:
            yield _table([row()])

    n = partitions(turns.sparkSession)
    placed = turns.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "tie")
    kind = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return placed.select("conv_id", "turn", "tie", "ids", "loss").mapInArrow(work, kind)


def _table(rows: list[list]) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
