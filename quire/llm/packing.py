"""Harmonic packing of tokenized documents into fixed-length sequences.

Class k holds the documents longer than capacity / (k + 1) and no longer than
capacity / k ids: k of them fit a sequence, whichever they are. Each sequence of
class k takes k whole documents; what room is left is filled by pieces of
documents that don't fit a sequence and must be cut anyway. Where there are too
few of those, some that fit are cut instead.

Every task fills the bins of all classes by itself, from the documents it
reads; nothing is shuffled. What its open bins hold at the end is packed by
falling length, and the last sequence is cut at powers of two, which need no
padding.
"""

from __future__ import annotations

import functools
import os
import re
import string
import zlib
from array import array
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
EOS_ID = 1  #: closes each document
MOST_CLASSES = 64  #: documents no longer than capacity / 64 are one class, of 64 in a bin
LEAST_PIECE = 16  #: a gap under this stays as padding
HELD_SEQUENCES = 16  #: ids that wait to fill gaps, and gaps that wait for ids, in sequences at most
MEMO_WORDS = 1_000_000  #: words whose ids a worker process remembers at a time
WORDS_AT_ONCE = 1000  #: words tokenized in one call
BYTES_AT_ONCE = 1 << 23  #: text whose words are learned at once, about
ROWS_PER_BATCH = 20_000
TASK_BITS = 40  #: a task numbers its sequences from partition << 40
#: letters up to U+012F, which composition leaves as they are
PLAIN_LETTERS = "".join(c for c in map(chr, range(0x130)) if c.isalpha())
PLAIN_WORD = re.compile(f"([{PLAIN_LETTERS}]+)([{re.escape(string.punctuation)}]*)")

COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(0x100 + len(letters) - len(plain)))
    return letters


class WordIds:
    """Ids of a space-free word, as little-endian 32-bit bytes, kept per word.

    The tokenizer drops white space and treats each word by itself, so a text's
    ids are its words' ids in order. A word of Latin letters, but for ASCII
    marks at its end, goes to the model by itself: lower-cased it is one token
    run, the marks are another. That holds where ``simple`` finds it of the
    tokenizer; other words are tokenized in full.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.tokenize = tokenizer.model.tokenize
        self.known: dict[bytes, bytes] = {}
        self.letters = {b: c for b, c in byte_letters().items() if b > 0x7F}
        self.plain = PLAIN_WORD.fullmatch if self.simple() else lambda text: None

    def simple(self) -> bool:
        """Whether plain letters reach the model as one run of byte letters, and marks after them as another."""
        pre, normal = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer
        if not pre or not normal:
            return False
        small = PLAIN_LETTERS.lower()
        return (normal.normalize_str(PLAIN_LETTERS + string.punctuation) == small + string.punctuation
                and [run for run, _ in pre.pre_tokenize_str(small + string.punctuation)]
                == [self.lettered(small), string.punctuation])

    def lettered(self, text: str) -> str:
        return text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes]) -> None:
        """Ids of all new ones of ``words``, which differ."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > MEMO_WORDS:  # those at hand are likely to come again
            self.known = {w: self.known[w] for w in words if w in self.known}
        runs: dict[str, bytes] = {}
        marks: dict[str, bytes] = {"": b""}
        other = []
        for word, text in zip(new, b" ".join(new).decode().split(" ")):
            found = self.plain(text)
            if not found:
                other.append(word)
                continue
            run, tail = found.groups()
            ids = runs.get(run)
            if ids is None:
                small = self.lettered(run if run.isascii() else run.lower())
                ids = runs[run] = self.known.get(run.encode()) or array("I", [t.id for t in self.tokenize(small)]).tobytes()
            if tail not in marks:
                marks[tail] = self.encode([tail])[0]
            self.known[word] = ids + marks[tail]
        for at in range(0, len(other), WORDS_AT_ONCE):
            part = other[at: at + WORDS_AT_ONCE]
            self.known.update(zip(part, self.encode([w.decode() for w in part])))


@functools.lru_cache(1)
def words_of(tokenizer_file: str, changed: float) -> WordIds:
    """One for all tasks that a worker process runs, as long as the file stays the same."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return WordIds(Tokenizer.from_file(tokenizer_file))


def document_ids(texts: list[bytes | None], words: WordIds) -> Iterator[bytes]:
    """Ids of each UTF-8 text (null: none) as bytes, without the closing one."""
    # a text with "<|" may hold special tokens, which are matched before anything else
    special = {at: text for at, text in enumerate(texts) if text and b"<|" in text}
    others = pa.array([b"" if at in special else text or b"" for at, text in enumerate(texts)], pa.large_binary())
    split = pc.ascii_split_whitespace(pc.ascii_lower(others.view(pa.large_string())))
    coded = split.values.dictionary_encode()
    each = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
    different = pc.binary_join(each, pa.scalar(" ", pa.large_string()))[0].as_buffer().to_pybytes().split(b" ")
    words.learn(different)
    ids = pa.array(list(map(words.known.__getitem__, different)), pa.large_binary()).take(coded.indices)
    _, ends, data = ids.buffers()
    held = memoryview(data or b"")
    at = np.frombuffer(ends, np.int64)[split.offsets.to_numpy()].tolist()
    for i, (start, end) in enumerate(zip(at, at[1:])):
        yield words.encode([special[i].decode()])[0] if i in special else bytes(held[start:end])


def harmonic_class(length: int, capacity: int) -> int:
    """How many documents of this length, or up to the next class's, fill a bin."""
    return min(capacity // length, MOST_CLASSES)


class Bins:
    """Open bins of every class. ``add`` and ``close`` yield finished sequences as lists of rows."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}  # class -> (doc_id, ids) of whole documents
        self.gaps: deque[tuple[int, list[tuple]]] = deque()  # counts of ids that full bins wait for
        self.room = 0
        self.spare: deque[list] = deque()  # [doc_id, start, ids] of documents to cut
        self.held = 0

    def add(self, doc_id, ids: bytes) -> Iterator[list[tuple]]:
        total, most = len(ids) // 4, HELD_SEQUENCES * self.capacity
        if total > self.capacity or self.room > most:
            self.keep(doc_id, ids)
            yield from self.fill_gaps()
            while self.held > most:
                yield self.emit(self.cut(self.capacity))
            return
        k = harmonic_class(total, self.capacity)
        docs = self.open.setdefault(k, [])
        docs.append((doc_id, ids))
        if len(docs) == k:
            gap = self.gap(self.open.pop(k))
            if gap < LEAST_PIECE:
                yield self.emit(self.whole(docs))
            else:
                self.gaps.append((gap, docs))
                self.room += gap
                yield from self.fill_gaps()

    def close(self) -> Iterator[list[tuple]]:
        """What is open: by falling length, each document where it fits best, and the emptiest
        sequences cut into the gaps of the others."""
        sequences = [[gap, docs] for gap, docs in self.gaps]
        for doc in sorted((d for docs in self.open.values() for d in docs), key=lambda d: -len(d[1])):
            fits = [s for s in sequences if s[0] >= len(doc[1]) // 4]
            if not fits:
                fits = [[self.capacity, []]]
                sequences += fits
            best = min(fits, key=lambda s: s[0])
            best[0] -= len(doc[1]) // 4
            best[1].append(doc)
        sequences.sort(key=lambda s: s[0])
        while sequences and sum(s[0] for s in sequences) > self.held:
            for doc in sequences.pop()[1]:
                self.keep(*doc)
        for gap, docs in sequences:
            yield self.emit(self.whole(docs) + self.cut(gap if gap >= LEAST_PIECE else 0))
        while self.held:
            yield self.emit(self.cut(min(self.capacity, 1 << self.held.bit_length() - 1)))

    def keep(self, doc_id, ids: bytes) -> None:
        self.spare.append([doc_id, 0, ids])
        self.held += len(ids) // 4

    def gap(self, docs: list[tuple]) -> int:
        return self.capacity - sum(len(ids) // 4 for _, ids in docs)

    def fill_gaps(self) -> Iterator[list[tuple]]:
        while self.gaps and self.held >= self.gaps[0][0]:
            gap, docs = self.gaps.popleft()
            self.room -= gap
            yield self.emit(self.whole(docs) + self.cut(gap))

    def whole(self, docs: list[tuple]) -> list[tuple]:
        return [(doc_id, 0, len(ids) // 4, zlib.crc32(ids), len(ids) // 4) for doc_id, ids in docs]

    def cut(self, size: int) -> list[tuple]:
        """Pieces of the kept documents, ``size`` ids in all."""
        out = []
        while size:
            head = self.spare[0]
            doc_id, start, ids = head
            total = len(ids) // 4
            length = min(size, total - start)
            out.append((doc_id, start, length, zlib.crc32(ids[4 * start: 4 * (start + length)]), total))
            head[1] += length
            if head[1] == total:
                self.spare.popleft()
            size -= length
            self.held -= length
        return out

    def emit(self, pieces: list[tuple]) -> list[tuple]:
        out, offset = [], 0
        for piece in pieces:
            out.append((*piece, self.next_id, offset))
            offset += piece[2]
        self.next_id += 1
        return out


def pack_documents(rows: Iterable[tuple], words: WordIds, capacity: int, eos_id: int,
                   first_id: int) -> Iterator[list[tuple]]:
    """Sequences of ``(doc_id, UTF-8 text)`` rows, as lists of pieces in ``COLUMNS`` order."""
    bins, eos = Bins(capacity, first_id), array("I", [eos_id]).tobytes()
    for group in _groups(rows):
        doc_ids, texts = zip(*group)
        for doc_id, ids in zip(doc_ids, document_ids(texts, words)):
            yield from bins.add(doc_id, ids + eos)
    yield from bins.close()


def _groups(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[1] or b"")
        if size > BYTES_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, eos_id: int = EOS_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is the ids of its whole text (null or empty: none) and the
    closing id. Each id lies in one piece; a sequence's pieces follow each other
    without gaps, and fill it but for ``LEAST_PIECE`` ids, or have a power of two
    in length. Documents that fit a sequence are whole, but for those that are
    needed to fill gaps. Repeated rows and null ids are packed like any others; an empty table
    gives no rows; other columns are ignored. ``capacity`` is a power of two.
    ``tokenizer_file`` is read by every task.
    """
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer_file, os.path.getmtime(tokenizer_file))
        rows = ((i.as_py(), t.as_py()) for b in batches for i, t in zip(b.column(0), b.column(1)))
        first = TaskContext.get().partitionId() << TASK_BITS
        held: list[tuple] = []
        for done in pack_documents(rows, words, capacity, eos_id, first):
            held += done
            if len(held) >= ROWS_PER_BATCH:
                yield as_batch(held)
                held = []
        if held:
            yield as_batch(held)

    kind = docs.schema[id_col].dataType

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(next(cols), id_type), *(pa.array(c, pa.int64()) for c in cols)], COLUMNS)

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)
    return docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(
        run, f"doc_id {kind.simpleString()}, " + ", ".join(f"{c} long" for c in COLUMNS[1:]))
