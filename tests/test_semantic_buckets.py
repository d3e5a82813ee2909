"""Semantic classes: what is dealt by band, small and large buckets, cosines near the threshold."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from test_rounds_semantic import VECTORS, class_brute

from quire.operators import semantic


def _classes(spark, rows):
    return {r.vec_id: r.class_id for r in semantic.semantic_classes(spark.createDataFrame(rows, VECTORS)).collect()}


def _clusters(seed):
    rng = np.random.default_rng(seed)
    return [(g * 100 + i, (c + 0.35 * rng.standard_normal(16)).tolist())
            for g, c in enumerate(rng.standard_normal((6, 16))) for i in range(12)]


@pytest.mark.parametrize("block", [1, 5, 512])
def test_buckets_of_any_size_lose_no_class(spark, monkeypatch, block):
    monkeypatch.setattr(semantic, "BLOCK", block)
    rows = _clusters(8)
    assert _classes(spark, rows) == class_brute(rows, semantic.THRESHOLD)


def test_cosines_next_to_the_threshold_are_exact(spark):
    """Pairs nearer to the threshold than 16-bit numbers tell: of plane angles, on either side of it."""
    angle, rows = np.arccos(0.9), []
    for k, off in enumerate((-1e-5, -1e-9, 1e-9, 1e-5)):
        for i, turn in enumerate((0.0, angle + off)):
            v = np.zeros(8)
            v[2 * k:2 * k + 2] = np.cos(turn), np.sin(turn)
            rows.append((10 * k + i, (v * (1 + i)).tolist()))
    assert 1e-5 < semantic.rounding(8)
    assert _classes(spark, rows) == {0: 0, 1: 0, 10: 10, 11: 10, 20: 20, 21: 21, 30: 30, 31: 31}


def test_rounded_products_keep_their_bound():
    m = np.random.default_rng(3).standard_normal((400, 64))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    raw = pa.array([r.tobytes() for r in np.rint(m * semantic.SHORT).astype(np.int16)], pa.binary())
    for column, rows in ((raw, m), (raw.slice(7, 90), m[7:97])):
        got = semantic._shorts(column, 64)
        assert np.abs(got @ got.T - rows @ rows.T).max() < semantic.rounding(64) < 3e-4


def test_bands_store_no_vectors(spark, tmp_dir, monkeypatch):
    """What is written doesn't grow with bands times vectors."""
    sizes, write = {}, semantic._written

    def written(df, name):
        out = write(df, name)
        sizes[name] = sizes.get(name, 0) + sum(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles())
        return out

    monkeypatch.setattr(semantic, "_written", written)
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((3000, 64)))]
    assert len(set(_classes(spark, rows).values())) == 3000
    assert sum(sizes.values()) < 2 * 3000 * 64 * 8 + 100_000, sizes
