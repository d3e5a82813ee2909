"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters with an error budget of k edits is split into
k + 1 pieces; k edits cannot touch all of them, so every occurrence within the
budget holds one piece unchanged. One Aho-Corasick automaton over all pieces
finds the exact piece hits in a text, and Myers' bit-parallel distance verifies
the item against the text around each hit.

The test items are a stated query set: they go to the workers in blocks of
bounded size, and each block reads the documents once. Documents are judged
where they are read; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

ERROR_RATE = 0.08  #: edits allowed, as a share of an item's characters
MIN_CHARS = 40  #: shorter items are matched exactly: an edit budget would hit common phrases
BLOCK_CHARS = 4_000_000  #: characters of test items sent to the workers at once
MEMO_WINDOWS = 20_000


def normalise(text: str | None) -> str:
    """Lower case, white-space runs as one space."""
    return " ".join((text or "").lower().split())


def error_budget(length: int, rate: float = ERROR_RATE) -> int:
    return int(length * rate) if length >= MIN_CHARS else 0


def split_pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces that cover the item, as (offset, piece)."""
    n, m = budget + 1, len(item)
    cuts = [i * m // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def pattern_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(item):
        masks[ch] = masks.get(ch, 0) | 1 << i
    return masks


def myers_search(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any substring of ``text``, and the
    first end position that reaches it."""
    ones = (1 << m) - 1
    top = 1 << (m - 1)
    up, down, score = ones, 0, m
    best, end = m, 0
    for j, ch in enumerate(text):
        eq = masks.get(ch, 0)
        vert = eq | down
        horiz = (((eq & up) + up) ^ up) | eq
        plus = down | (ones & ~(horiz | up))
        minus = up & horiz
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & ones  # bit 0 stays clear: a match may start anywhere
        minus = minus << 1 & ones
        up = minus | (ones & ~(vert | plus))
        down = plus & vert
        if score < best:
            best, end = score, j + 1
    return best, end


def build_index(items: list[tuple[int, str]], rate: float):
    """The automaton of all pieces, and per item its text, budget and masks."""
    import ahocorasick

    known, pieces = [], ahocorasick.Automaton()
    for item_id, text in items:
        budget = error_budget(len(text), rate)
        known.append((item_id, len(text), budget, pattern_masks(text)))
        for offset, piece in split_pieces(text, budget):
            pieces.add_word(piece, [*pieces.get(piece, []), (len(known) - 1, offset, len(piece))])
    pieces.make_automaton()
    return pieces, known


def find_items(text: str, pieces, known, memo: dict) -> list[tuple[int, int, int, int]]:
    """(item_id, distance, start, end) of each item found in a normalised text.

    ``end`` is where the best occurrence ends, ``start`` a position at or
    before its start by at most the budget.
    """
    spans: dict[int, list[tuple[int, int]]] = {}
    for last, found in pieces.iter(text):
        for i, offset, length in found:
            m, budget = known[i][1], known[i][2]
            start = last + 1 - length - offset
            at = (max(0, start - budget), min(len(text), start + m + budget))
            own = spans.setdefault(i, [])
            if own and at[0] <= own[-1][1] and at[1] - own[-1][0] <= 3 * m + 2 * budget:
                own[-1] = (min(at[0], own[-1][0]), max(at[1], own[-1][1]))
            else:
                own.append(at)
    out = []
    for i, ranges in spans.items():
        item_id, m, budget, masks = known[i]
        best = None
        for a, b in ranges:
            key = (i, text[a:b])
            hit = memo.get(key)
            if hit is None:
                if len(memo) >= MEMO_WINDOWS:
                    memo.clear()
                hit = memo[key] = myers_search(masks, m, key[1])
            distance, end = hit
            if distance <= budget and (best is None or distance < best[1]):
                best = (item_id, distance, max(0, a + end - m - distance), a + end)
        if best:
            out.append(best)
    return out


def _blocks(items: DataFrame, item_col: str, text_col: str, block_chars: int):
    """The items in lists of at most ``block_chars`` characters (or one item)."""
    block, size = [], 0
    rows = items.where(F.col(text_col).isNotNull()).select(item_col, text_col)
    for item_id, text in rows.orderBy(item_col, text_col).toLocalIterator():
        text = normalise(text)
        if not text:
            continue
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, distance, start_char, end_char``: one row per document
    row and test item found within the error budget (its best occurrence).

    Positions are in the normalised text (lower case, single spaces). Null or
    blank texts and items match nothing; repeated items or rows give a row
    each; an empty table gives no rows; other columns are ignored. Texts are
    read whole.
    """
    spark = docs.sparkSession
    kinds = (docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString())
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, start_char int, end_char int"
    item_type = to_arrow_type(items.schema[item_col].dataType)
    source = docs.select(id_col, text_col)

    def search(block: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces, known = build_index(shared.value, rate)
            memo: dict = {}
            for batch in batches:
                at, rows = [], []
                for k, text in enumerate(batch.column(1)):
                    text = normalise(text.as_py())
                    for hit in find_items(text, pieces, known, memo) if text else ():
                        at.append(k)
                        rows.append(hit)
                cols = list(zip(*rows)) if rows else [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array(cols[0], item_type),
                     *(pa.array(c, pa.int32()) for c in cols[1:])],
                    ["doc_id", "item_id", "distance", "start_char", "end_char"])

        return source.mapInArrow(run, schema)

    found = None
    for block in _blocks(items, item_col, item_text_col, block_chars):
        part = search(block)
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def drop_leaks(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text",
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in whose text no test item is found; all columns kept.

    Each row is judged by its own text, in the task that reads it. Null, empty
    and repeated rows and empty tables behave as in ``find_leaks``.
    """
    spark = docs.sparkSession
    at = docs.columns.index(text_col)

    def sieve(rows: DataFrame, block: list) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pieces, known = build_index(shared.value, rate)
            memo: dict = {}
            for batch in batches:
                texts = map(normalise, (t.as_py() for t in batch.column(at)))
                yield batch.filter(pa.array(
                    [not (t and find_items(t, pieces, known, memo)) for t in texts], pa.bool_()))

        return rows.mapInArrow(run, docs.schema)

    for block in _blocks(items, item_col, item_text_col, block_chars):
        docs = sieve(docs, block)
    return docs
