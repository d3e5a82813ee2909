"""Embedding whitening by a bidiagonal qd solver.

Centred rows are reduced by blockwise QR: each task keeps one triangle R of
its rows, and groups of triangles are stacked and reduced level by level.
Householder reflections bidiagonalise the last R; the dqds algorithm finds the
singular values of the bidiagonal to high relative accuracy; twisted
factorisations of its squared form give the right singular vectors, which the
reflections carry back to whitening directions. The covariance is never formed.

Only matrices of the vectors' dimension, whatever the number of rows, pass
through the driver and one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000  #: an entry c counts as floor(SCALE * c) + SHIFT
FAN_IN = 16  #: triangles reduced to one at each level
ROWS_AT_ONCE = 4096  #: rows in memory as a matrix, and under one QR step
EPS = np.finfo(np.float64).eps
CLUSTER = 1e-3  #: singular values this close, relatively, are made orthogonal to each other


# the vectors ----------------------------------------------------------------
def usable(batch: pa.RecordBatch, at: int, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` by vector length: rows that are not null and hold finite numbers only."""
    vectors = batch.column(at)
    flat = np.asarray(vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    lengths = np.diff(offsets)
    good = np.asarray(vectors.is_valid().to_numpy(zero_copy_only=False)) & (lengths > 0)
    broken = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))  # null entries are read as NaN
    good &= broken[offsets[1:]] == broken[offsets[:-1]]
    for length in np.unique(lengths[good]).tolist() if size is None else [size]:
        rows = np.flatnonzero(good & (lengths == length))
        for at in range(0, len(rows), ROWS_AT_ONCE):
            part = rows[at: at + ROWS_AT_ONCE]
            yield part, flat[offsets[part][:, None] + np.arange(length)]


def levels(vectors: np.ndarray) -> np.ndarray:
    """Entries as longs: floor(SCALE * c) + SHIFT. Entries beyond +-2^38 are held there."""
    return np.floor(SCALE * np.clip(vectors, -(2.0 ** 38), 2.0 ** 38)).astype(np.int64) + SHIFT


def fit_sums(vectors: DataFrame, vector_col: str) -> tuple[int, list[int]]:
    """``(n, sums per dimension)`` over usable vectors of the length that most of them have.

    A tie goes to the greater length. Sums are exact.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for rows, matrix in usable(batch, 0):
                n, sums = held.get(matrix.shape[1], (0, np.zeros(matrix.shape[1], object)))
                held[matrix.shape[1]] = n + len(rows), sums + levels(matrix).sum(axis=0).astype(object)
        out = [(size, n, pos, str(s)) for size, (n, sums) in held.items() for pos, s in enumerate(sums.tolist())]
        if out:
            size, n, pos, total = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(size, pa.int32()), pa.array(n, pa.int64()),
                                              pa.array(pos, pa.int32()), pa.array(total, pa.string())],
                                             ["size", "n", "pos", "total"])

    sums = cut(vectors.select(vector_col).mapInArrow(run, "size int, n long, pos int, total string")
               .groupBy("size", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    best = sums.agg(F.max_by("size", F.struct("n", "size"))).first()[0]
    if best is None:
        return 0, []
    rows = sorted(sums.where(F.col("size") == best).collect(), key=lambda r: r["pos"])  # one row a dimension
    return rows[0]["n"], [int(r["total"]) for r in rows]


def centred(matrix: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, each difference rounded once: its whole and fractional parts are exact."""
    whole = np.array([s // n for s in sums], np.int64)
    part = np.array([(s % n) / n for s in sums])
    return (levels(matrix) - whole).astype(np.float64) - part


# blockwise QR ---------------------------------------------------------------
def stack_qr(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


def triangle(vectors: DataFrame, vector_col: str, n: int, sums: list[int]) -> np.ndarray:
    """R of the centred usable rows: at most one row a dimension."""
    size = len(sums)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, size))
        for batch in batches:
            for _, matrix in usable(batch, 0, size):
                r = stack_qr([r, centred(matrix, n, sums)])
        if len(r):
            yield as_batch(r)

    def as_batch(r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], ["r"])

    def reduce_group(group: pa.Table) -> pa.Table:
        r = np.zeros((0, size))
        for flat in group.column("r"):
            r = stack_qr([r, np.asarray(flat.as_py()).reshape(-1, size)])
        return pa.Table.from_batches([as_batch(r)])

    parts = cut(vectors.select(vector_col).mapInArrow(reduce_rows, "r array<double>"))
    while (count := parts.count()) > 1:
        groups = -(-count // FAN_IN)
        # the groups of a level are of FAN_IN triangles on average, dealt by content
        parts = cut(parts.groupBy(F.expr(f"pmod(xxhash64(r), {groups})").alias("g"))
                    .applyInArrow(reduce_group, "r array<double>"))
    row = parts.first()
    return np.asarray(row["r"]).reshape(-1, size) if row else np.zeros((0, size))


# Householder bidiagonalisation -----------------------------------------------
def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """``(v, tau, alpha)`` with (I - tau v v') x = alpha e1."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0 or not np.any(x[1:]):
        return np.zeros_like(x), 0.0, float(x[0])
    y = x / scale
    norm = math.sqrt(float(y @ y))
    alpha = -math.copysign(norm, y[0])
    v = y.copy()
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha * scale


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, right)``: r = left * bidiag(a, b) * right', upper bidiagonal, right orthogonal."""
    size = r.shape[1]
    m = np.zeros((size, size))
    m[: len(r)] = r
    right = np.eye(size)
    a, b = np.zeros(size), np.zeros(max(size - 1, 0))
    for k in range(size):
        v, tau, a[k] = _reflector(m[k:, k])
        m[k:, k:] -= tau * np.outer(v, v @ m[k:, k:])
        if k < size - 1:
            v, tau, b[k] = _reflector(m[k, k + 1:])
            m[k:, k + 1:] -= tau * np.outer(m[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= tau * np.outer(right[:, k + 1:] @ v, v)
    return a, b, right


# dqds -------------------------------------------------------------------------
def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd step with a shift, or None if the shift is above the least eigenvalue."""
    new_q, new_e = [], []
    d = low = q[0] - shift
    if d < 0:
        return None
    for i in range(len(e)):
        total = d + e[i]
        if total <= 0:
            if shift:
                return None
            new_q.append(0.0)
            new_e.append(0.0)
            d = q[i + 1]
            low = 0.0
            continue
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        if not d >= 0:
            return None
        low = min(low, d)
    new_q.append(d)
    return new_q, new_e, low


def singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values of the upper bidiagonal with diagonal ``a`` and superdiagonal ``b``, falling."""
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(a))
    found: list[float] = []
    work = [(((np.asarray(a) / scale) ** 2).tolist(), ((np.asarray(b) / scale) ** 2).tolist(), 0.0)]
    small = (16 * EPS) ** 2
    while work:
        q, e, sigma = work.pop()
        shift = 0.0
        while len(q) > 1:
            if e[-1] <= small * (sigma + q[-1]) or e[-1] < 1e-300:
                found.append(sigma + q.pop())
                e.pop()
                shift = 0.0
                continue
            split = next((i for i in range(len(e) - 1, -1, -1)
                          if e[i] <= small * (sigma + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
            if split is not None:
                work.append((q[: split + 1], e[:split], sigma))
                q, e = q[split + 1:], e[split + 1:]
                continue
            if q[0] < q[-1]:  # read from its other end: the same values, small ones at the end
                q, e = q[::-1], e[::-1]
            step = _dqds_step(q, e, shift)
            while step is None:  # above the least eigenvalue: nearer to zero
                shift = shift / 4 if shift > 1e-12 * (sigma + q[-1]) else 0.0
                step = _dqds_step(q, e, shift)
            q, e, low = step
            sigma += shift
            shift = _next_shift(q, e, low)
        if q:
            found.append(sigma + q[0])
    return scale * np.sqrt(np.sort(found)[::-1])


def _next_shift(q: list[float], e: list[float], low: float) -> float:
    """A shift that should stay below the least eigenvalue; ``low``, the step's least pivot, is never below it.

    With the least pivot last, the eigenvalue is the last entry less what its
    coupling to the row above can take; otherwise it is a part of the pivot.
    """
    if low < q[-1]:
        return low / 4
    room, pull = q[-2] + e[-1] - q[-1], e[-1] * q[-1]
    if room > 0 and room * room > pull:
        return max(q[-1] - pull / room, low / 2)
    return low / 2


# twisted factorisations ---------------------------------------------------------
def _twisted(q: np.ndarray, off: np.ndarray, diagonal: np.ndarray, value: float) -> np.ndarray:
    """The vector of (T - value) by its twisted factorisation, T the squared bidiagonal.

    T = L D L' with D = q. The stationary transform runs down, the progressive
    one up, both in differential form; they meet where the twist is least.
    """
    n = len(q)
    if n == 1:
        return np.ones(1)
    tiny = EPS * EPS * max(float(diagonal.max()), 1e-300)
    low = off / np.where(q[:-1] == 0, tiny, q[:-1])  # entries of L
    lld = low * off  # l^2 d
    plus, minus = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        d = q[i] + s[i]
        d = d if abs(d) > tiny else math.copysign(tiny, d)
        plus[i] = off[i] / d
        s[i + 1] = plus[i] * low[i] * s[i] - value
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        d = lld[i] + p[i + 1]
        d = d if abs(d) > tiny else math.copysign(tiny, d)
        t = q[i] / d
        minus[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    gamma = s + p + value
    k = int(np.argmin(np.abs(gamma)))
    v = np.zeros(n)
    v[k] = 1.0
    for i in range(k - 1, -1, -1):
        v[i] = -plus[i] * v[i + 1]
    for i in range(k, n - 1):
        v[i + 1] = -minus[i] * v[i]
    return v / math.sqrt(float(v @ v))


def right_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors of the bidiagonal as columns, for its greatest singular values.

    A split bidiagonal is solved by its parts. Vectors of singular values that
    nearly agree are made orthogonal, by inverse iteration where they are not
    independent.
    """
    size = len(a)
    scale = max(float(np.abs(a).max(initial=0.0)), float(np.abs(b).max(initial=0.0)), 1e-300)
    a, b, values = a / scale, b / scale, values / scale
    cuts = np.flatnonzero(np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:])) * 0.5) + 1
    edges = [0, *cuts.tolist(), size]
    pool = []  # (value, first, last) of every singular value of every part
    for lo, hi in zip(edges, edges[1:]):
        pool += [(v, lo, hi) for v in singular_values(a[lo:hi], b[lo: hi - 1])]
    pool.sort(key=lambda x: -x[0])
    out = np.zeros((size, len(values)))
    rng = np.random.default_rng(0)
    for j, (value, lo, hi) in enumerate(pool[: len(values)]):
        x, y = a[lo:hi], b[lo: hi - 1]
        q, off = x * x, x[:-1] * y
        diagonal = q + np.concatenate(([0.0], y * y))
        near = [i for i in range(j) if pool[i][0] - value <= CLUSTER * pool[i][0] and pool[i][1] == lo]
        v = _twisted(q, off, diagonal, value * value)
        kept = v - out[lo:hi, near] @ (out[lo:hi, near].T @ v)
        length = math.sqrt(float(kept @ kept))
        if near and length < 0.5:  # the cluster's vectors coincide: inverse iteration from another start
            v = rng.standard_normal(hi - lo)
            shifted = np.diag(diagonal - value * value * (1 + 4 * EPS)) + np.diag(off, 1) + np.diag(off, -1)
            for _ in range(4):
                v -= out[lo:hi, near] @ (out[lo:hi, near].T @ v)
                v = _solve(shifted, v / np.linalg.norm(v))
                v /= np.linalg.norm(v)
            kept = v - out[lo:hi, near] @ (out[lo:hi, near].T @ v)
        kept -= out[lo:hi, near] @ (out[lo:hi, near].T @ kept)
        out[lo:hi, j] = kept / np.linalg.norm(kept)
    return out


def _solve(m: np.ndarray, v: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(m, v)
    except np.linalg.LinAlgError:  # exactly singular: any shift off it by rounding will do
        return np.linalg.solve(m + np.eye(len(v)) * (EPS * max(np.abs(m).max(), 1e-300)), v)


def directions(r: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """``(singular values, unit directions as columns, sum of all squared singular values)`` of R.

    At most ``components``, and only those that stand above rounding.
    """
    if not r.size or not np.any(r):
        return np.zeros(0), np.zeros((r.shape[1], 0)), 0.0
    a, b, right = bidiagonalise(r)
    values = singular_values(a, b)
    above = int((values > values[0] * 64 * len(values) * EPS).sum())
    top = values[: min(components, above)]
    return top, right @ right_vectors(a, b, top), float(values @ values)


# the operator -----------------------------------------------------------------
def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n, deviation, whitened, explained, identity_error``, one row per usable vector.

    ``whitened`` and ``explained`` hold one entry per component, by falling
    eigenvalue; ``deviation`` (decimal) is the exact sum over dimensions of
    (n x - S)^2. A vector is usable if neither it nor an entry of it is null,
    NaN or infinite and it has the length that most such vectors have. Where
    fewer components have a positive eigenvalue, fewer are returned (none for a
    single row or equal rows: empty arrays, identity error 0). Repeated rows
    and null ids count like others; no usable vector gives no rows; other
    columns are ignored.
    """
    n, sums = fit_sums(vectors, vector_col)
    size = len(sums)
    values, axes, square = directions(triangle(vectors, vector_col, n, sums), components) if n else (
        np.zeros(0), np.zeros((0, 0)), 0.0)
    scale = axes * (math.sqrt(n) / values if n else values)  # sqrt(e) is the singular value over sqrt(n)
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in usable(batch, 1, size) if n else ():
                far = deviations(levels(matrix), n, sums)
                flat = (centred(matrix, n, sums) @ scale).ravel()
                ends = np.arange(len(rows) + 1, dtype=np.int32) * scale.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(list(map(str, far.tolist())), pa.string()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["vec_id", "deviation", "whitened"])

    out = written(vectors.select(id_col, vector_col).mapInArrow(
        run, f"vec_id {kind}, deviation string, whitened array<double>")
        .withColumn("deviation", F.col("deviation").cast("decimal(38,0)")), "whitening")
    error = _identity_error(out, len(values))
    explained = F.array(*(F.lit(float(v * v / square)) for v in values)).cast("array<double>")
    return out.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      explained.alias("explained"), F.lit(error).alias("identity_error"))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Exact sums over dimensions of (n x - S)^2: as longs where they surely fit, else as Python's integers."""
    gap, rest = x - np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    reach = n * (int(np.abs(gap).max()) + 1)
    if reach * reach * x.shape[1] >= 1 << 63:
        gap, rest = gap.astype(object), rest.astype(object)
    return ((n * gap - rest) ** 2).sum(axis=1)


def _identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance less the identity, centred before multiplying."""
    if not k:
        return 0.0
    entry = [F.get("whitened", i) for i in range(k)]
    means = whitened.agg(*(F.avg(e).alias(f"m{i}") for i, e in enumerate(entry))).first()
    gaps = [e - F.lit(m) for e, m in zip(entry, means)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = whitened.agg(*(F.avg(gaps[i] * gaps[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))
