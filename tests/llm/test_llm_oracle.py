"""The training-data queries that SQL can express, against DuckDB."""

import os
import sys

import pytest

from llm_helpers import SF01

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

from check_oracle import compare, duck  # noqa: E402
from quire.llm.oracle import ORACLE_SQL  # noqa: E402
from quire.llm.queries import QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, duck(SF01), name, QUERIES[name], ORACLE_SQL[name], SF01)
    assert r["ok"], r


def test_every_operator_has_a_query():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
