"""Periodic runs of words by scale-tiled distribution.

A run is a stretch of words with smallest period q, at least three periods and
24 words long, that no neighbouring word extends. Periods are searched by
octave: a run of an octave's periods holds a whole aligned block of that
octave's size which occurs again one period on, so equal block hashes say where
to look. A document is exploded into overlapping tiles around such blocks, a
size for each octave; tiles are dealt over all tasks and solved by themselves
with Z-functions from the block boundaries, forwards and backwards. What they
find are fragments of runs, cut at the tile's ends; fragments are shuffled by
document and period and stitched to whole runs.

Equal texts have one key, so their tiles are solved once. A task holds one
document, or one tile, at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, written

LEAST_WORDS, LEAST_PERIODS = 24, 3
LEAST_BLOCK = 8  #: block of the octaves below it: 24 words less a period under 8 hold an aligned one
LEAST_CORE = 256  #: words of a tile without its margins, at least
BYTES_AT_ONCE = 1 << 24
TILE = "struct<octave:int,low:int,core:int,core_end:int,codes:array<int>>"


def octaves(n: int) -> Iterator[int]:
    """Least periods of the octaves whose runs fit ``n`` words."""
    least = 1
    while n >= max(LEAST_WORDS, LEAST_PERIODS * least):
        yield least
        least *= 2


def block_size(least: int) -> int:
    return max(least, LEAST_BLOCK)


def block_hashes(codes: np.ndarray, size: int, halves: np.ndarray | None = None) -> np.ndarray:
    """Hashes of all windows of ``size`` words (a power of two), from those of half the size if given."""
    if halves is None:
        halves, width = _mix(codes.astype(np.uint64)), 1
    else:
        width = size // 2
    while width < size and len(halves) > width:
        halves = _mix(halves[:-width] * np.uint64(0x9E3779B97F4A7C15) + (halves[width:] ^ np.uint64(width)))
        width *= 2
    return halves if width == size else halves[:0]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def recurring_blocks(hashes: np.ndarray, least: int) -> np.ndarray:
    """Positions of the aligned blocks that occur again ``least`` to ``2 * least - 1`` words on."""
    n, block = len(hashes), block_size(least)
    if least < block:
        met = np.zeros(-(-n // block), bool)
        for q in range(least, min(2 * least, n)):
            same = hashes[:-q: block] == hashes[q::block]
            met[: len(same)] |= same
        return np.flatnonzero(met) * block
    if n <= least:
        return np.zeros(0, np.int64)
    rows = -(-(n - least) // least)
    later = np.zeros(rows * least, np.uint64)
    later[: n - least] = hashes[least:]
    same = later.reshape(rows, least) == hashes[: rows * least: least][:rows, None]
    same.ravel()[n - least:] = False
    return np.flatnonzero(same.any(axis=1)) * least


def document_tiles(codes: np.ndarray) -> list[tuple]:
    """``(octave, low, core, core end, codes)`` of the tiles whose core holds a recurring block."""
    out, hashes = [], None
    n = len(codes)
    for least in octaves(n):
        block = block_size(least)
        if hashes is None or block > LEAST_BLOCK:
            hashes = block_hashes(codes, block, hashes)
        if hashes is not None and block == LEAST_BLOCK and least == 1 and len(np.unique(hashes)) == len(hashes):
            return []  # no block occurs twice at all
        core = max(4 * block, LEAST_CORE)
        for tile in np.unique(recurring_blocks(hashes, least) // core).tolist():
            low = max(0, tile * core - block)
            end = min(n, (tile + 1) * core + 2 * block + 2 * least)
            out.append((least, low, tile * core, min(n, (tile + 1) * core), codes[low:end]))
    return out


def z_function(s: list[int], stop: int) -> list[int]:
    """Z[i] for i < stop: how many elements from i on agree with the start of ``s``."""
    n = len(s)
    z = [0] * stop
    left = right = 0
    for i in range(1, stop):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def _powers(reach: np.ndarray, stop: int) -> np.ndarray:
    """Which q < stop are no smallest period: the first q words repeat a shorter root.

    ``reach[p]``: how many words from the boundary on have period p.
    """
    power = np.zeros(stop, bool)
    roots = np.flatnonzero(reach >= 2 * np.arange(len(reach)))
    for p in roots[roots > 0].tolist():  # few: primitive squares that start at one place
        if not power[p]:
            power[2 * p: min(stop, int(reach[p]) + 1): p] = True
    return power


def solve_tile(least: int, low: int, core: int, core_end: int, codes: np.ndarray) -> list[tuple[int, int, int]]:
    """``(period, start, end)``: words start <= i < end agree with those a period on.

    Positions are the document's. An interval ends where the words differ or at
    the tile's end. Periods are the octave's; a period of which a divisor is one
    is left out.
    """
    n, block = len(codes), block_size(least)
    hashes = block_hashes(codes, block)
    whole = codes.tolist()
    seen = np.zeros(2 * least, np.int64)  # by period: how far intervals are known
    out = []
    for boundary in range(core - low, min(core_end - low, len(hashes)), block):
        later = hashes[boundary + least: boundary + 2 * least]
        periods = least + np.flatnonzero(later == hashes[boundary])
        if not len(periods) or np.all(seen[periods] >= boundary + block):
            continue
        stop = min(2 * least, n - boundary)
        ahead = np.array(z_function(whole[boundary:], stop))
        back = whole[:boundary][::-1]
        text = whole[: boundary + stop][::-1]
        behind = z_function(back + [-1] + text, len(back) + 1 + len(text))[len(back) + 1:]
        power = _powers(ahead + np.arange(stop), stop)
        for q in range(least, stop):
            if ahead[q] < block or seen[q] >= boundary + block:
                continue
            end = boundary + int(ahead[q])
            seen[q] = end
            if not power[q]:
                out.append((q, low + boundary - behind[stop - q], low + end))
    return out


def _tiled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, n_words, words, tiles`` per row; ``words`` is the text with single blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        tile = pa.struct([*((name, pa.int32()) for name in ("octave", "low", "core", "core_end")),
                          ("codes", pa.list_(pa.int32()))])
        names = ["doc_id", "key", "n_words", "words", "tiles"]
        for batch in batches:
            held, size, first = [], 0, 0
            for i, text in enumerate(batch.column(1)):
                words = (text.as_py() or b"").split()  # bytes split at ASCII white space only
                joined = b" ".join(words)
                tiles = []
                if len(words) >= LEAST_WORDS:
                    number: dict[bytes, int] = {}
                    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int32)
                    tiles = [dict(zip(tile.names, t)) for t in document_tiles(codes)]
                held.append((xxh3_128_digest(joined), len(words), joined, tiles))
                size += len(joined) + sum(8 * len(t["codes"]) for t in tiles)
                if size > BYTES_AT_ONCE or i == len(batch.column(1)) - 1:
                    key, n, joined_, tiles_ = zip(*held)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, len(held)), pa.array(key, pa.binary()), pa.array(n, pa.int64()),
                         pa.array(joined_, pa.binary()), pa.array(tiles_, pa.list_(tile))], names)
                    held, size, first = [], 0, i + 1

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(
        run, f"doc_id {kind}, key binary, n_words long, words binary, tiles array<{TILE}>")
    return out.withColumn("words", F.decode("words", "UTF-8"))


def _fragments(tiles: DataFrame) -> DataFrame:
    """``key, period, start, end`` of all tiles, each solved by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, least, low, core, core_end, codes in zip(*(batch.column(i) for i in range(6))):
                numbers = codes.values.to_numpy()
                found += [(key.as_py(), *f) for f in solve_tile(
                    least.as_py(), low.as_py(), core.as_py(), core_end.as_py(), numbers)]
            if found:
                key, period, start, end = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.binary()), *(pa.array(c, pa.int64()) for c in (period, start, end))],
                    ["key", "period", "start", "end"])

    return tiles.select("key", "octave", "low", "core", "core_end", "codes").mapInArrow(
        run, "key binary, period long, start long, end long")


def _stitched(fragments: DataFrame) -> DataFrame:
    """Runs of each key: overlapping or touching intervals of a period become one."""
    order = Window.partitionBy("key", "period").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = (fragments.distinct()
               .withColumn("opens", F.when(F.col("start") <= before, 0).otherwise(1))
               .withColumn("island", F.sum("opens").over(order)))
    length = F.col("end") - F.col("start") + F.col("period")
    return (islands.groupBy("key", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .select("key", "start", length.alias("length"), "period")
            .where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period"))))


def _collapsed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``words`` less those in a run after its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("words"), batch.column("runs")):
                words = text.as_py().split(" ")
                stay = np.ones(len(words), bool)
                for r in runs.as_py():
                    stay[r["start"] + r["period"]: r["start"] + r["length"]] = False
                out.append(" ".join(words[i] for i in np.flatnonzero(stay)))
            at = batch.schema.get_field_index("words")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if i == at else c for i, c in enumerate(
                batch.columns)], batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row of ``docs``.

    ``runs``: array of ``start, length, period`` by start, then period; words
    are ``[^\\x20\\x09-\\x0D]+`` of the whole text, numbered from 0.
    ``collapsed``: the words joined by one space, without those that a run holds
    after its first period. A null or empty text has no words, no runs and an
    empty ``collapsed``. Repeated rows and null ids give a row each; an empty
    table gives none; other columns are ignored.
    """
    tiled = _tiled(docs, id_col, text_col)
    some = written(tiled.where(F.size("tiles") > 0), "runs")
    tiles = some.select("key", F.explode("tiles").alias("t")).select("key", "t.*")
    # equal texts have equal tiles: solved once, and dealt by key and place
    tiles = tiles.groupBy("key", "octave", "low").agg(
        F.first("core").alias("core"), F.first("core_end").alias("core_end"), F.first("codes").alias("codes"))
    runs = _stitched(cut(_fragments(tiles)))
    # checkpointed, so that the join that follows can split a text of very many copies
    by_key = cut(runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period")))
                                         .alias("runs")))
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    held = (some.select("doc_id", "n_words", "words", "key").join(by_key, "key", "left")
            .select("doc_id", "n_words", F.coalesce("runs", none).alias("runs"), "words"))
    plain = tiled.where(F.size("tiles") == 0).select("doc_id", "n_words", none.alias("runs"), "words")
    return (_collapsed(held).unionByName(plain)).withColumnRenamed("words", "collapsed")


def best_run(runs: Column) -> Column:
    """The run of the greatest exact length / period; ties: smallest start, then period. Null if none."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def with_planted_period(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: one document in ten, by a hash of its id, goes on with its own words periodically.

    h = crc32 of the decimal id, g = floor(h / 10). If h % 10 = 0 and there are
    n > 0 words, word i >= a is word a + (i - a) % p, with a = g % n and
    p = 1 + floor((n - a) / (3 + g % 8)). A null id has no hash.
    """
    hashed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         F.crc32(F.col(id_col).cast("string").cast("binary")).alias("h"))

    def planted(text: Column) -> Column:
        words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
        return F.transform(F.array(F.struct(words.alias("w"), F.floor(F.col("h") / 10).alias("g"))), grown)[0]

    def grown(x: Column) -> Column:
        w, g = x["w"], x["g"]
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), tail), " ")).otherwise("")

    return hashed.select("doc_id", F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), planted(F.col("text")))
                         .otherwise(F.col("text")).alias("text"))
