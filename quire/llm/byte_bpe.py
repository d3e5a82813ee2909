"""Byte-level BPE by a sentencepiece model that is written from the vocabulary itself.

A rank file lists byte strings by rank. Each becomes a piece whose bytes are
spelled as letters, scored by its negative rank, so that the model's merges
(best score first, then leftmost) are those of the ranks. The model has an
identity normaliser and no white space handling; nothing is trained.

A text is split by the pattern, and each match is encoded by itself. Ids are
turned back to bytes by the inverse spelling. Both run where the row is read;
nothing is shuffled.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .packing import byte_letters

MEMO_TOKENS = 500_000  #: pre-tokens whose ids a task remembers at a time
TOKENS_AT_ONCE = 200_000  #: pre-tokens of a text held as strings at a time
BYTES_AT_ONCE = 1 << 24  #: text encoded to one output batch, about
UNKNOWN = "⁇"  #: the piece that a model must have; no byte is spelled so
BPE, NORMAL_PIECE, UNKNOWN_PIECE = 2, 1, 2  #: numbers of the model format


def read_ranks(path: str) -> list[bytes]:
    """Byte strings of a rank file (base64 and rank per line) in the order of rank.

    Ranks run from 0 without gaps and every single byte is among them.
    """
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks have gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a byte has no rank")
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _number(field: int, value: int) -> bytes:
    """A varint field; negative numbers as 64-bit two's complement."""
    return _varint(field << 3) + _varint(value & (1 << 64) - 1)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    body = _bytes(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind)
    return _bytes(1, body)


def spell(data: bytes, table: dict[int, str]) -> str:
    return data.decode("latin-1").translate(table)


def build_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose ids are the ranks; the unknown piece is the last."""
    letters = byte_letters()
    pieces = [_piece(spell(t, letters), -float(rank), NORMAL_PIECE) for rank, t in enumerate(tokens)]
    pieces.append(_piece(UNKNOWN, 0.0, UNKNOWN_PIECE))
    # fields: model kind, size, and ids of unknown, begin, end and padding
    trainer = (_number(3, BPE) + _number(4, len(pieces)) + _number(40, len(tokens))
               + b"".join(_number(field, -1) for field in (41, 42, 43)) + _bytes(45, UNKNOWN.encode()))
    # name, and no dummy prefix, no removal and no escape of white space
    normalizer = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normalizer)


class TokenIds:
    """Ids of pre-tokens, remembered; those that are whole tokens of the vocabulary are looked up."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}

    def learn(self, tokens: set[str]) -> None:
        """Encodes the unknown ones of ``tokens`` in one call."""
        new = tokens.difference(self.known)
        if new and len(self.known) + len(new) > MEMO_TOKENS:
            self.known, new = {}, tokens
        if new:
            spelled = {spell(t.encode(), self.letters): t for t in new}
            whole = dict(zip(spelled, self.model.piece_to_id(list(spelled))))
            merged = [s for s, i in whole.items() if i == self.model.unk_id()]
            self.known.update((spelled[s], array("i", [i]).tobytes()) for s, i in whole.items())
            for s, ids in zip(merged, self.model.encode(merged, out_type=int, num_threads=1)):
                self.known[spelled[s]] = array("i", ids).tobytes()

    def __call__(self, tokens: list[str]) -> bytes:
        """Ids of known tokens in order, as 32-bit integers."""
        return b"".join(map(self.known.__getitem__, tokens))


def _token_parts(texts: pa.Array, split) -> Iterator[list[tuple[int, list[str]]]]:
    """Lists of (row, pre-tokens), of about ``TOKENS_AT_ONCE`` in all; a long text is cut over several."""
    held, size = [], 0
    for row, text in enumerate(texts):
        matches = (match[0] for match in split(text.as_py() or ""))
        while tokens := list(islice(matches, TOKENS_AT_ONCE)):
            held.append((row, tokens))
            size += len(tokens)
            if size >= TOKENS_AT_ONCE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BYTES_AT_ONCE`` bytes of text, one row at least."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > start and held + n > BYTES_AT_ONCE:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array of int) per row of ``docs``.

    Ids are the ranks that greedy merging by rank leaves of each pattern match
    of the whole text; what the pattern doesn't match has none. A null or empty
    text has no ids. Special tokens aren't looked for: their strings are
    ordinary text. Repeated rows and null ids give a row each; an empty table
    gives none; other columns are ignored. The model is built once from
    ``ranks_file``, which the driver reads, and broadcast (its size is the
    vocabulary's).
    """
    model = docs.sparkSession.sparkContext.broadcast(build_model(read_ranks(ranks_file)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, ids_of = regex.compile(pattern).finditer, TokenIds(model.value)
        for batch in batches:
            for a, b in _groups(batch.column(1)):
                flat, counts = bytearray(), np.zeros(b - a + 1, np.int32)
                for parts in _token_parts(batch.column(1).slice(a, b - a), split):
                    ids_of.learn(set().union(*(tokens for _, tokens in parts)))
                    for row, tokens in parts:
                        encoded = ids_of(tokens)
                        flat += encoded
                        counts[row + 1] += len(encoded) // 4
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)),
                                               pa.array(np.frombuffer(flat, np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks_file: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes that the ids stand for, by the inverse spelling.

    Bytes, since ids may end within a character. Null ids give null, no ids no
    bytes; an id outside the vocabulary is an error. All columns are kept; one
    named ``decoded`` is replaced.
    """
    model = encoded.sparkSession.sparkContext.broadcast(build_model(read_ranks(ranks_file)))
    rest = encoded.drop("decoded")
    at = rest.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        inverse = {ord(letter): byte for byte, letter in byte_letters().items()}
        tokens = pa.array([pieces.id_to_piece(i).translate(inverse).encode("latin-1")
                           for i in range(pieces.unk_id())], pa.binary())
        for batch in batches:
            ids = batch.column(at)
            parts = pa.ListArray.from_arrays(ids.offsets, tokens.take(ids.values), mask=ids.is_null())
            yield pa.RecordBatch.from_arrays([*batch.columns, pc.binary_join(parts, b"")],
                                             [*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(run, f"{fields}, decoded binary")
