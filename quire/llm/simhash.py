"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are laid into tiles by the population counts of their
four 16-bit quarters. Two fingerprints within the radius have quarter counts
that differ by no more than the radius in sum, so every other pair of tiles is
skipped. Tiles of bounded size meet by a join on tile and block; numpy compares
each pair of blocks exactly by exclusive-or and bit counts.

Exact copies share one fingerprint and are compared once. A pair of blocks
gives a spanning forest of its links (at most one row per fingerprint), which
keeps all components without writing all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, hex64
from .graph import components

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
QUARTERS, QUARTER_BITS = 4, 16
BLOCK = 2048  #: fingerprints compared at once, about
HASHES_AT_ONCE = 1 << 16


def fingerprint(data: bytes, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, A-Z lower-cased."""
    from xxhash import xxh64_intdigest as digest

    words = data.lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        return digest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = len(words) - shingle + 1
    set_bits = np.zeros(64, np.int64)
    for at in range(0, total, HASHES_AT_ONCE):
        to = min(total, at + HASHES_AT_ONCE)
        hashes = np.array([digest(line[a:b], seed) for a, b in zip(
            starts[at:to].tolist(), ends[at + shingle - 1: to + shingle - 1].tolist())], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * set_bits > total).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed long) per row; a text without words has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py() or b"", shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(run, f"doc_id {kind}, fp long")


def _quarter_counts(fp: Column) -> list[Column]:
    mask = (1 << QUARTER_BITS) - 1
    return [F.bit_count(F.shiftright(fp, QUARTER_BITS * i).bitwiseAND(F.lit(mask))) for i in range(QUARTERS)]


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts within the radius, one of each +/- pair."""
    zero = (0,) * QUARTERS
    near = product(range(-radius, radius + 1), repeat=QUARTERS)
    return [d for d in near if sum(map(abs, d)) <= radius and d >= zero]


def block_links(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within the radius: each fingerprint that
    has a partner, and the least of its group in these two blocks."""
    nodes, where = np.unique(np.concatenate((left, right)), return_inverse=True)
    at_left, at_right = where[: len(left)], where[len(left):]
    near_a, near_b = [], []
    step = max(1, (1 << 20) // max(1, len(right)))
    for i in range(0, len(left), step):
        far = np.bitwise_count(left[i: i + step, None] ^ right[None, :])
        a, b = np.nonzero(far <= radius)
        a, b = at_left[a + i], at_right[b]
        other = a != b
        near_a.append(a[other].astype(np.int32))
        near_b.append(b[other].astype(np.int32))
    a, b = np.concatenate(near_a), np.concatenate(near_b)
    label = np.arange(len(nodes), dtype=np.int32)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def near_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: a spanning forest of all pairs of ``fp`` values within the radius.

    ``distinct``: one row per fingerprint. Each block of a tile meets the blocks
    of the tiles whose counts are near enough, once.
    """
    tile = [f"q{i}" for i in range(QUARTERS)]
    laid = distinct.select("fp", *(c.alias(n) for n, c in zip(tile, _quarter_counts(F.col("fp")))))
    # at most (QUARTER_BITS + 1) ** QUARTERS = 83,521 tiles, whatever the input
    sizes = cut(laid.groupBy(tile).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))
    blocks = cut(
        laid.join(F.broadcast(sizes), tile)
        .groupBy(*tile, F.expr("cast(pmod(xxhash64(fp, 1), blocks) as int)").alias("block"))
        .agg(F.sort_array(F.collect_list("fp")).alias("fps")))
    steps = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(tile, d))) for d in _steps(radius)))
    reach = (blocks.withColumn("d", F.explode(steps))
             .select(*(F.col(n).alias(f"from_{n}") for n in tile), F.col("block").alias("from_block"),
                     F.col("fps").alias("left"), *((F.col(n) + F.col(f"d.{n}")).alias(n) for n in tile))
             .join(F.broadcast(sizes), tile)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    same = F.lit(True)
    for n in tile:
        same = same & (F.col(n) == F.col(f"from_{n}"))
    met = (reach.where(~same | (F.col("from_block") <= F.col("block")))
           .join(blocks.withColumnRenamed("fps", "right"), [*tile, "block"])
           .select("left", "right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1)):
                a, b = block_links(*(x.values.to_numpy().view(np.uint64) for x in (left, right)), radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    ``component_id`` is the least ``doc_id`` reachable over links of at most
    ``radius`` differing bits (itself included; null ids are not counted).
    Texts without words (null, empty, blank) have fingerprint zero and link
    like any other. Repeated rows give a row each; an empty table gives none;
    other columns are ignored.
    """
    prints = cut(fingerprints(docs, shingle, id_col, text_col))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = cut(components(near_links(distinct.select("fp"), radius)))
    linked = roots.join(distinct, roots.node == distinct.fp).select("root", "fp", "low")
    least = cut(linked.groupBy("root").agg(F.min("low").alias("component_id")))
    linked = linked.join(least, "root").select(F.col("fp").alias("linked_fp"), "component_id")
    # checkpointed, so that the join that follows can split a fingerprint of very many copies
    named = cut(distinct.join(linked, distinct.fp == linked.linked_fp, "left")
                .select("fp", F.coalesce("component_id", "low").alias("component_id")))
    return prints.join(named, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def _row_hash(df: DataFrame) -> Column:
    """Hash of all columns; nulls count, wherever they stand."""
    return F.xxhash64(*(x for c in sorted(df.columns) for x in (F.col(c), F.col(c).isNull())))


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each group: that of the least ``doc_id`` (null last); all columns kept.

    Of several rows with that id, whatever their texts, one is chosen by a hash
    of its columns. Rows that agree in all columns count as one. The choice is
    made on ids and hashes; texts are shuffled once, to meet it.
    """
    keyed = docs.withColumn("__row", _row_hash(docs))
    prints = fingerprints(keyed.withColumn("__id", F.struct("doc_id", "__row")), shingle, "__id")
    # equal rows are summed first, and what joins is checkpointed, so that a hot fingerprint can be split
    rows = cut(prints.select("doc_id.*", "fp").groupBy("doc_id", "__row", "fp").agg(F.count(F.lit(1)).alias("n")))
    roots = cut(components(near_links(cut(rows.select("fp").distinct()), radius)))
    named = rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row", "n")
    chosen = cut(named.groupBy(F.coalesce("root", "fp").alias("group")).agg(F.min(order).alias("first"))
                 .select(F.col("first.doc_id").alias("__id"), F.col("first.__row").alias("__chosen"), "first.n"))

    def rows_of(some: DataFrame) -> DataFrame:
        some = some.drop("n")
        met = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__chosen"))
        return keyed.join(some, met, "left_semi")

    single, repeated = chosen.where("n = 1"), chosen.where("n > 1")
    kept = rows_of(single)
    if not repeated.isEmpty():
        kept = kept.unionByName(rows_of(repeated).dropDuplicates(["doc_id", "__row"]))
    return kept.select(docs.columns)
