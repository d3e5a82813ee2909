"""Layer 3: every registered query against its DuckDB SQL at sf0.01, and the
driver entry point on sf0.001."""

import os
import sys

import pytest

from conftest import ROOT, SF01

sys.path.insert(0, os.path.join(ROOT, "scripts"))
os.environ.setdefault("STRICT", "1")   # exact float comparison

import __spark_entry__ as entry  # noqa: E402
from check_oracle import compare, duck  # noqa: E402
from quire import oracle_sql, registry  # noqa: E402

NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_sql():
    assert set(oracle_sql.oracle_sql()) == set(registry.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF01)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns
