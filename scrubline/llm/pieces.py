"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives one Viterbi pass.

The automaton over all pieces reads a text once; at each position its output links name every piece
that ends there, longest first, and each relaxes the best score of that position. Between two
characters that no piece holds side by side, a text can be cut without changing the result: texts
fall into independent words, whose ids a task keeps in a bounded cache.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import astuple, dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# The sign for a blank within pieces.
BLANK = "▁"
# An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
# Words whose ids a task remembers, in each of two generations; the older one goes first.
MOST_WORDS = 150_000
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, ids of the 256 byte pieces, and which ids stand for text."""

    pieces: list[str]
    scores: list[float]
    bytes_at: list[int]
    plain: list[bool]


def load(model: str = MODEL) -> Vocabulary:
    """Read a model file; it needs byte pieces for characters that no piece covers."""
    read = sentencepiece.SentencePieceProcessor(model_file=model)
    size = read.get_piece_size()
    pieces = [read.id_to_piece(i) for i in range(size)]
    bytes_at = {pieces[i]: i for i in range(size) if read.is_byte(i)}
    if len(bytes_at) != 256:
        raise ValueError("the model has no byte pieces, so some texts could not be decoded again")
    plain = [
        not (read.is_byte(i) or read.is_control(i) or read.is_unknown(i) or read.is_unused(i))
        for i in range(size)
    ]
    scores = [read.get_score(i) for i in range(size)]
    return Vocabulary(pieces, scores, [bytes_at[f"<0x{b:02X}>"] for b in range(256)], plain)


@dataclass
class Codec:
    """Encodes and decodes single texts."""

    vocabulary: Vocabulary
    _automaton: ahocorasick.Automaton = field(init=False)
    _words: dict[str, bytes] = field(init=False)

    def __post_init__(self) -> None:
        known = self.vocabulary
        self._automaton = ahocorasick.Automaton()
        texts = [(p, i) for i, p in enumerate(known.pieces) if known.plain[i] and p]
        for piece, i in texts:
            self._automaton.add_word(piece, (i, len(piece), known.scores[i]))
        self._automaton.make_automaton()
        self._single = {p for p, _ in texts if len(p) == 1}
        self._unknown = min((known.scores[i] for _, i in texts), default=0.0) - UNKNOWN_PENALTY
        side_by_side = {p[i : i + 2] for p, _ in texts for i in range(len(p) - 1)}
        self._cut = _cutter(side_by_side, {c for p, _ in texts for c in p})
        self._words = _Words(self)
        written = [p.replace(BLANK, " ").encode() for p in known.pieces]
        for byte, i in enumerate(known.bytes_at):
            written[i] = bytes([byte])
        self._written = [w if known.plain[i] or i in set(known.bytes_at) else b"" for i, w in enumerate(written)]
        escaped = [known.bytes_at[b] for b in BLANK.encode()]
        self._escaped = np.array(escaped, "<i4").tobytes()

    def viterbi(self, text: str) -> list[int]:
        """The pieces of ``text`` (blanks written as BLANK) with the highest sum of scores.

        Ties go to the longer last piece; characters without a piece become their bytes.
        """
        n, single, unknown = len(text), self._single, self._unknown
        some_unknown = not single.issuperset(text)
        best = [0.0] + [float("-inf")] * n
        came, by = [0] * (n + 1), [-1] * (n + 1)
        settled = 0

        def settle(upto: int) -> None:
            for at in range(settled + 1, upto + 1):
                if text[at - 1] not in single and best[at - 1] + unknown > best[at]:
                    best[at], came[at], by[at] = best[at - 1] + unknown, at - 1, -1

        for end, (piece, length, score) in self._automaton.iter(text):
            if some_unknown and end > settled:
                settle(end)
                settled = end
            start = end + 1 - length
            found = best[start] + score
            if found > best[end + 1]:
                best[end + 1], came[end + 1], by[end + 1] = found, start, piece
        if some_unknown:
            settle(n)
        ids, at = [], n
        while at:
            if by[at] >= 0:
                ids.append(by[at])
            else:
                written = text[at - 1].encode("utf-8", "replace")
                ids.extend(self.vocabulary.bytes_at[b] for b in reversed(written))
            at = came[at]
        return ids[::-1]

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit numbers; none for a null or empty text."""
        if not text:
            return b""
        blanked = " " + text
        parts = [
            b"".join(map(self._words.__getitem__, self._cut.findall(part.replace(" ", BLANK))))
            for part in blanked.split(BLANK)
        ]
        # The blank sign itself is written as bytes, so that it can be told from a blank.
        return self._escaped.join(parts)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; the blank that encoding puts in front is taken off."""
        whole = b"".join(map(self._written.__getitem__, ids))
        return (whole[1:] if whole[:1] == b" " else whole).decode("utf-8", "replace")

    def tidy(self) -> None:
        self._words.tidy()


class _Words(dict):
    """Ids of words, found when first asked for."""

    def __init__(self, codec: Codec):
        super().__init__()
        self._codec = codec
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            found = self._codec.viterbi(word)
            ids = struct.pack(f"<{len(found)}i", *found)
        # Very long words are not worth remembering.
        if len(word) < 48:
            self[word] = ids
        return ids

    def tidy(self) -> None:
        if len(self) > MOST_WORDS:
            self.older = dict(self)
            self.clear()


def _cutter(side_by_side: set[str], used: set[str]) -> re.Pattern:
    """A pattern whose matches are words that no piece can reach across.

    A word begins with a run of blanks, or with a run of punctuation that no piece holds behind
    another character; control characters that no piece holds stand alone.
    """
    if any(pair[1] == BLANK and pair[0] != BLANK for pair in side_by_side):
        return re.compile("(?s).+")
    marks = set(_PUNCTUATION)
    while True:
        bound = {p[1] for p in side_by_side if p[1] in marks and p[0] not in marks and p[0] != BLANK}
        if not bound:
            break
        marks -= bound
    alone = "".join(re.escape(chr(c)) for c in range(32) if chr(c) not in used)
    mark = "".join(map(re.escape, sorted(marks)))
    plain = f"[^{BLANK}{mark}{alone}]"
    ways = [f"{BLANK}*{plain}+", f"{BLANK}+"]
    if mark:
        ways.insert(0, f"{BLANK}*[{mark}]+{plain}*")
    if alone:
        ways.append(f"[{alone}]")
    return re.compile("|".join(ways))


def _with_codec(df: DataFrame, vocabulary: Vocabulary, rule, schema: str) -> DataFrame:
    # Plain lists: a class of this package could not be read where the package is not installed.
    shared = df.sparkSession.sparkContext.broadcast(astuple(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One per task: its cache goes when the task ends, as executors have other work to do.
        codec = Codec(Vocabulary(*shared.value))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                yield rule(codec, batch.slice(start, 256))
                codec.tidy()
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id``, ``n_ids``, ``ids``, ``round_trip`` for every row: its whole text in pieces.

    ``round_trip`` says whether decoding ``ids`` gives the text back. Null and empty texts have no
    ids; repeated rows stay repeated; other columns are ignored; an empty table gives no rows. The
    broadcast is the vocabulary of the model, whose size does not depend on the data.
    """

    def rule(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        found = [np.frombuffer(codec.encode(text), "<i4") for text in texts]
        same = [codec.decode(ids.tolist()) == (text or "") for ids, text in zip(found, texts, strict=True)]
        counts = np.array([len(ids) for ids in found], np.int32)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        flat = np.concatenate([*found, np.zeros(0, "<i4")])
        columns = [
            batch.column(0),
            pa.array(counts),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
            pa.array(same),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "ids", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n_ids int, ids array<int>, round_trip boolean"
    return _with_codec(rows, load(model), rule, schema)


def decoded(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id``, ``text`` from ``doc_id``, ``ids``; null ids give a null text."""

    def rule(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if ids is None else codec.decode(ids) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return _with_codec(rows.select("doc_id", "ids"), load(model), rule, "doc_id long, text string")
