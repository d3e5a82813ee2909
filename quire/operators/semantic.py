"""Semantic dedupe: classes of vectors whose cosine reaches a threshold.

Random hyperplanes cut each direction into bits; bands of bits are buckets in
which near vectors meet. How many bits and bands follows from the number of
vectors, the threshold and the recall that is asked for. Every link is checked
by its exact cosine.

Vectors meet as 16-bit numbers, dealt once for each band and not stored. Their
products tell nearly all pairs for sure, as rounding moves a cosine by a known
bound at most; the few within that bound of the threshold are checked on the
vectors themselves.

Equal vectors count once. A bucket of up to ``BLOCK`` members is compared where
it lies. A larger one is never gathered or paired whole: each member is first
held against the bucket's first vector; those that are near it are linked to it,
which keeps the class, and only the rest is compared with all members, block by
block. Comparing gives a spanning forest of the links, never all pairs, and
components of the links are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir, shared_path
from .graph import components, cut

THRESHOLD = 0.9
RECALL = 0.999  #: of a pair at the threshold; nearer pairs are found more surely
BLOCK = 512  #: vectors compared at once
SEED = 20260101
SHORT = 32767  #: what 1 is as a 16-bit number


def band_plan(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """``(bits of a band, bands)``: bits grow with the logarithm of ``n``, so that a bucket of
    unrelated vectors doesn't, and bands so that a pair at the threshold shares one with
    probability ``recall``."""
    bits = max(8, math.ceil(math.log2(max(n, 2))) - 4)
    same = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(1 - recall) / math.log1p(-same ** bits))


def _matrix(column: pa.Array) -> np.ndarray:
    ends = column.offsets.to_numpy()
    return column.values.to_numpy()[ends[0]: ends[-1]].reshape(len(column), -1)


def _floats(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def unit_vectors(vectors: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """``id, unit`` of the rows with a direction: ``size`` finite entries, not all zero."""
    usable = ((F.size(vector_col) == size) & ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
              & F.exists(vector_col, lambda x: x != 0))
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch.column(0)):
                m = _matrix(batch.column(1))
                m = m / np.abs(m).max(axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), _floats(m / np.sqrt((m * m).sum(axis=1, keepdims=True)))], ["id", "unit"])

    return (vectors.where(usable).select(F.col(id_col), F.col(vector_col).cast("array<double>"))
            .mapInArrow(run, f"id {kind}, unit array<double>"))


def _shorts(column: pa.Array, size: int) -> np.ndarray:
    """The rounded unit vectors of a binary column; products of their rows are cosines."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    raw = np.frombuffer(column.buffers()[2], np.int16, (ends[-1] - ends[0]) // 2, ends[0])
    return raw.reshape(len(column), size).astype(np.float32) / SHORT


def rounding(size: int) -> float:
    """How far a product of rounded unit vectors is from their cosine, at most: either moves by half a
    step an entry, and sums of 32-bit numbers by their own rounding."""
    moved = 0.5 / SHORT * math.sqrt(size)
    return moved * (2 + moved) + (size + 2) * 2.0 ** -23


def _banded(distinct: DataFrame, size: int, bits: int, bands: int, vectors: bool = True) -> DataFrame:
    """``band, code, id, short``: a row for each band of each vector (only ``band, code`` without ``vectors``)."""
    kind = distinct.schema["id"].dataType.simpleString()
    names = ["band", "code", "id", "short"][:4 if vectors else 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(SEED).standard_normal((size, bits * bands))
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            if not len(batch.column(0)):
                continue
            m = _matrix(batch.column(1))
            codes = ((m @ planes >= 0).reshape(len(m), bands, bits) * weights).sum(axis=2)
            short = np.rint(m * SHORT).astype(np.int16)
            columns = [batch.column(0), pa.array([row.tobytes() for row in short], pa.binary())] if vectors else []
            for band in range(bands):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(m), band, np.int32)), pa.array(codes[:, band]), *columns], names)

    return distinct.select("id", "unit").mapInArrow(
        run, "band int, code long" + (f", id {kind}, short binary" if vectors else ""))


def _with_first(members: DataFrame, size: int, threshold: float) -> DataFrame:
    """``members`` (with ``first``, the bucket's first vector) with ``near``: whether it is that near for sure."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in members.schema if f.name != "first")
    least = threshold + rounding(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c for c, n in zip(batch.columns, batch.schema.names) if n != "first"]
            near = pa.array([], pa.bool_())
            if len(columns[0]):
                near = pa.array((_shorts(batch.column("short"), size) * _shorts(batch.column("first"), size)).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([*columns, near], [n for n in batch.schema.names if n != "first"] + ["near"])

    return members.mapInArrow(run, fields + ", near boolean")


def block_forest(left: np.ndarray, right: np.ndarray, threshold: float, slack: float = 0.0,
                 same: bool = False) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Pairs (row of left, row of right) that join what is linked across the two blocks, and no more; and
    those within ``slack`` of the threshold that would join more. ``same``: both are one block."""
    cosines = left @ right.T
    pairs = np.argwhere(cosines >= threshold - slack)
    shift = 0 if same else len(left)
    if same:
        pairs = pairs[pairs[:, 0] < pairs[:, 1]]
    sure = cosines[pairs[:, 0], pairs[:, 1]] >= threshold + slack
    root = list(range(len(left) + (0 if same else len(right))))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in pairs[sure].tolist():
        x, y = find(a), find(shift + b)
        if x != y:
            root[x] = y
            out.append((a, b))
    return out, [(a, b) for a, b in pairs[~sure].tolist() if find(a) != find(shift + b)]


def _links(ids: tuple, found: tuple) -> pa.RecordBatch:
    """``a, b, sure`` of the pairs found between the rows of ``ids``."""
    pairs = np.array([*found[0], *found[1]], dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [ids[0].take(pa.array(pairs[:, 0])), ids[1].take(pa.array(pairs[:, 1])),
         pa.array(np.arange(len(pairs)) < len(found[0]))], ["a", "b", "sure"])


def _small_buckets(rows: DataFrame, size: int, threshold: float) -> DataFrame:
    """``a, b, sure`` within buckets; rows of a bucket stand together in one task."""
    slack = rounding(size)
    kind = rows.schema["id"].dataType.simpleString()

    def compare(run_of: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        band, code = run_of.column("band").to_numpy(), run_of.column("code").to_numpy()
        cuts = np.flatnonzero((np.diff(band) != 0) | (np.diff(code) != 0)) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(band))
        m, first, second = _shorts(run_of.column("short"), size), [], []
        for start, end in zip(starts.tolist(), ends.tolist()):
            if end - start > 1:
                for out, pairs in zip((first, second), block_forest(m[start:end], m[start:end], threshold, slack, same=True)):
                    out.extend((start + a, start + b) for a, b in pairs)
        if first or second:
            yield _links((run_of.column("id"),) * 2, (first, second))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last bucket of a batch may go on in the next
        for batch in batches:
            if not len(batch.column(0)):
                continue
            if held is not None:
                batch = pa.concat_batches([held, batch])
            band, code = batch.column("band").to_numpy(), batch.column("code").to_numpy()
            last = len(band) - int(np.argmin(np.append(((band == band[-1]) & (code == code[-1]))[::-1], False)))
            yield from compare(batch.slice(0, last)) if last else ()
            held = batch.slice(last)
        if held is not None:
            yield from compare(held)

    dealt = rows.repartition("band", "code").sortWithinPartitions("band", "code")
    return dealt.mapInArrow(run, f"a {kind}, b {kind}, sure boolean")


def _large_buckets(rows: DataFrame, size: int, threshold: float) -> DataFrame:
    """``a, b, sure`` within buckets of ``n`` rows, dealt by blocks."""
    bucket, slack = ["band", "code"], rounding(size)
    kind = rows.schema["id"].dataType.simpleString()
    rows = _written(rows, "semantic-large")
    # one row a bucket; checkpointed, so that the join can split a bucket of very many rows
    firsts = cut(rows.groupBy(bucket).agg(F.min(F.struct("id", "short")).alias("f"))
                 .select(*bucket, F.col("f.id").alias("first_id"), F.col("f.short").alias("first")))
    members = _written(_with_first(rows.join(firsts, bucket), size, threshold), "semantic-members")
    to_first = members.where("near and id <> first_id").select(F.col("id").alias("a"), F.col("first_id").alias("b"),
                                                               F.lit(True).alias("sure"))

    def blocks(some: DataFrame, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)).alias("block")
        return some.groupBy(*bucket, block).agg(F.collect_list(F.struct("id", "short")).alias(name)).drop("block")

    pairs = cut(blocks(members.where("not near"), "rest")).join(cut(blocks(members, "all")), bucket).select("rest", "all")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rest, every in zip(batch.column(0), batch.column(1)):
                rest, every = rest.values, every.values
                found = block_forest(_shorts(rest.field("short"), size), _shorts(every.field("short"), size), threshold, slack)
                if found[0] or found[1]:
                    yield _links((rest.field("id"), every.field("id")), found)

    return to_first.unionByName(pairs.mapInArrow(run, f"a {kind}, b {kind}, sure boolean")).where("a <> b")


def _exact(pairs: DataFrame, distinct: DataFrame, threshold: float) -> DataFrame:
    """The ``a, b`` whose vectors are that near."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)
    for s in "ab":
        pairs = pairs.join(distinct.select(F.col("id").alias(s), F.col("unit").alias(f"unit_{s}")), s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch.column(0)):
                near = (_matrix(batch.column(2)) * _matrix(batch.column(3))).sum(axis=1) >= threshold
                yield batch.select(["a", "b"]).filter(pa.array(near))

    return pairs.select("a", "b", "unit_a", "unit_b").mapInArrow(run, fields)


def near_links(distinct: DataFrame, size: int, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``a, b``: links whose components are the classes of ``id, unit`` rows (different vectors)."""
    bits, bands = band_plan(distinct.count(), threshold, recall)
    bucket = ["band", "code"]
    large = _written(_banded(distinct, size, bits, bands, vectors=False).groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > BLOCK), "semantic-large-buckets")
    rows = _banded(distinct, size, bits, bands)
    found = _small_buckets(rows.join(large, bucket, "left_anti"), size, threshold).distinct()
    if not large.isEmpty():
        found = found.unionByName(_large_buckets(rows.join(large, bucket), size, threshold))
    found = _written(found, "semantic-links")
    unsure = found.where("not sure").select("a", "b").distinct()
    return found.where("sure").select("a", "b").unionByName(_exact(unsure, distinct, threshold)).distinct()


def semantic_classes(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                     id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, class_id`` per row: the least id reachable over cosines of at least ``threshold``.

    Vectors are of the length that most rows have; others, null ones, those with
    a null or non-finite entry and those of zeros have no direction and are a
    class by their own id. Rows with a null id are left out; rows that repeat an
    id count as one node. An empty table gives no rows; other columns are ignored.
    """
    rows = vectors.where(F.col(id_col).isNotNull())
    sizes = rows.groupBy(F.size(vector_col).alias("size")).count().where("size > 0")
    size = sizes.agg(F.max_by("size", F.struct("count", "size"))).first()[0]
    ids = rows.select(F.col(id_col).alias("id")).distinct()
    if size is None:
        return ids.select(F.col("id").alias(id_col), F.col("id").alias("class_id"))
    units = _written(unit_vectors(rows, id_col, vector_col, size), "semantic-units")
    keyed = units.withColumn("key", F.xxhash64("unit")).withColumn("key2", F.xxhash64(F.lit(1), "unit"))
    # equal vectors, and rows that repeat an id, are linked to their first before any compare
    distinct = cut(keyed.groupBy("key", "key2").agg(F.min("id").alias("id"), F.first("unit").alias("unit")))
    firsts = distinct.select("key", "key2", F.col("id").alias("first_id"))
    copies = keyed.select("id", "key", "key2").join(firsts, ["key", "key2"]).where("id <> first_id")
    links = near_links(distinct, size, threshold, recall).unionByName(copies.select(
        F.col("id").alias("a"), F.col("first_id").alias("b")))
    roots = cut(components(links))
    return (ids.join(roots, ids["id"] == roots["node"], "left")
            .select(ids["id"].alias(id_col), F.coalesce("root", ids["id"]).alias("class_id")))


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder; what follows reads the files."""
    import uuid
    shared_dir(df.sparkSession)
    path, schema = shared_path(df.sparkSession, "quire", f"{name}-{uuid.uuid4().hex[:12]}"), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
