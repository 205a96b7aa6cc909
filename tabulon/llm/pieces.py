"""SentencePiece encoding and decoding with an Aho-Corasick automaton and a single-pass Viterbi.

The automaton over all pieces reads a text once; at every position its output links give the pieces
that end there, and each relaxes the best score of that position. The segmentation with the highest sum of
piece scores wins; of equal sums the one whose last piece is longest. A character that no piece covers
goes to byte pieces at ``lowest score - 10``. No piece has the blank mark after another character, so texts fall apart
at blanks without changing the optimum; segments are kept in a bounded cache per task.
The pieces are read from a public model file whose path is a parameter; nothing is trained.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
CACHE = 3 << 17
#: Rows worked on at a time.
ROWS = 256


@dataclass
class Pieces:
    """The vocabulary: normal pieces with scores, and the ids of the 256 byte pieces."""

    scores: dict[str, tuple[float, int]]
    byte_ids: list[int]
    texts: list[bytes]
    _ready: tuple = field(default=None, repr=False)

    def __getstate__(self):
        return {"scores": self.scores, "byte_ids": self.byte_ids, "texts": self.texts, "_ready": None}

    def encoder(self) -> Callable[[str], bytes]:
        """Text to int32 ids as bytes. Built once per worker."""
        if self._ready is None:
            self._ready = (_encoder(self),)
        return self._ready[0]

    def decode(self, ids) -> str:
        """Ids back to the text they were made from."""
        out = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8")
        return out[1:] if out.startswith(" ") else out


def load_pieces(path: str = MODEL) -> Pieces:
    """Read the vocabulary of a model file (on the driver; tasks get it with their code: its size is the vocabulary's)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, byte_ids, texts = {}, [0] * 256, []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
            texts.append(bytes([int(piece[3:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            texts.append(b"")
        else:
            scores[piece] = (model.get_score(i), i)
            texts.append(piece.replace(BLANK, " ").encode())
    return Pieces(scores, byte_ids, texts)


def _encoder(pieces: Pieces) -> Callable[[str], bytes]:
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for piece, (score, i) in pieces.scores.items():
        automaton.add_word(piece, (len(piece), score, i))
    automaton.make_automaton()
    lowest = min((s for s, _ in pieces.scores.values()), default=0.0) - 10
    letters = set("".join(pieces.scores))
    if any(BLANK in p.lstrip(BLANK) for p in pieces.scores):
        parts = re.compile(r"(?s).+")  # such a vocabulary would join words: no cuts then
    else:
        apart = "".join(c for c in "\t\n\r" if c not in letters)
        parts = re.compile(f"{BLANK}+[^{BLANK}{apart}]*|[^{BLANK}{apart}]+" + (f"|[{apart}]" if apart else ""))
    if any(score > 0 for score, _ in pieces.scores.values()):
        raise ValueError("piece scores are logarithms, at most 0")
    byte_ids, matches, young, old = pieces.byte_ids, automaton.iter, {}, {}
    # a blank mark that stands in the text itself must not become a blank: it is carried as an unassigned code point
    hidden, minus = "￿", -1e300

    def segment(part: str) -> bytes:
        n = len(part)
        best, start, piece = [0.0] + [minus] * n, [0] * (n + 1), [0] * (n + 1)
        for end, (length, score, i) in matches(part):  # follows output links: longest piece first
            at = end + 1 - length
            value = best[at] + score
            if value > best[end + 1]:
                best[end + 1], start[end + 1], piece[end + 1] = value, at, i
        if best[n] <= lowest:  # else no way over bytes can be as good: no score is above 0
            return spelled(part)
        ids, at = [], n
        while at:
            ids.append(piece[at])
            at = start[at]
        ids.reverse()
        return array("i", ids).tobytes()

    def spelled(part: str) -> bytes:
        """As ``segment``, with the way over bytes open at every character."""
        n, last = len(part), 0
        best, back = [0.0] + [minus] * n, [None] * (n + 1)
        for end, (length, score, i) in [*matches(part), (n, (0, 0.0, -1))]:
            while last <= end and last < n:
                last += 1
                best[last], back[last] = best[last - 1] + lowest, (last - 1, -1)
            value = best[end + 1 - length] + score if length else minus
            if length and value > best[end + 1]:
                best[end + 1], back[end + 1] = value, (end + 1 - length, i)
        ids, at = [], n
        while at:
            before, i = back[at]
            if i >= 0:
                ids.append(i)
            else:
                char = part[before]
                raw = (BLANK if char == hidden else char).encode()
                ids.extend(byte_ids[b] for b in reversed(raw))
            at = before
        return array("i", ids[::-1]).tobytes()

    def encode(text: str) -> bytes:
        if not text:
            return b""
        if hidden in text:  # both characters occur: cut the text there and spell the noncharacter in bytes
            gap = array("i", [byte_ids[b] for b in hidden.encode()]).tobytes()
            runs = [encode_run(r, k == 0) for k, r in enumerate(text.split(hidden))]
            return gap.join(runs)
        return encode_run(text, True)

    def encode_run(text: str, first: bool) -> bytes:
        text = text.replace(BLANK, hidden).replace(" ", BLANK)
        if first:
            text = BLANK + text
        nonlocal young, old
        out, look = [], young.get
        for part in parts.findall(text):
            ids = look(part)
            if ids is None:
                ids = old.get(part)
                if ids is None:
                    ids = segment(part)
                if len(part) <= 64:
                    if len(young) >= CACHE:  # what was not used in the last generation is forgotten
                        young, old = {}, young
                        look = young.get
                    young[part] = ids
            out.append(ids)
        return b"".join(out)

    return encode


def _slices(batches):
    """Batches cut small: a task holds the texts and ids of few rows at a time, whatever the size of an Arrow batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def encode(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """All columns of ``docs`` (with text) and ids array<int>, n_pieces long. Null and empty texts have no pieces.

    A text gets one blank in front, as the model file asks; decoding takes it away. Columns with the new names are replaced.
    """
    docs = docs.drop("ids", "n_pieces")
    at = docs.columns.index("text")

    def work(batches):
        run = pieces.encoder()
        for batch in _slices(batches):
            raw = [run(t or "") for t in batch.column(at).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in raw])])
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(raw), np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(np.diff(ends))], names=[*batch.schema.names, "ids", "n_pieces"])

    kind = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType())])
    return docs.mapInArrow(work, kind)


def decode(rows: DataFrame, pieces: Pieces) -> DataFrame:
    """All columns of ``rows`` (with ids) and decoded string; null ids give the empty text."""
    rows = rows.drop("decoded")
    at = rows.columns.index("ids")

    def work(batches):
        for batch in _slices(batches):
            column = batch.column(at)
            ends = column.offsets.to_numpy()
            ids = column.values.to_numpy()[ends[0] : ends[-1]].tolist()  # one conversion for all rows; null rows span nothing
            ends = ends - ends[0]
            texts = [pieces.decode(ids[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return rows.mapInArrow(work, T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())]))


def round_trip(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """(doc_id, n_pieces, ids, decoded_sha256, exact): encoded, decoded from the ids, compared with the text (null: empty)."""
    rows = decode(encode(docs.select("doc_id", "text"), pieces), pieces)
    exact = F.col("decoded") == F.coalesce("text", F.lit(""))
    return rows.select("doc_id", "n_pieces", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), exact.alias("exact"))
