"""Plan properties that must hold at any scale: no cartesian or nested-loop
joins, and hot keys (hash, record id) are never the partition key of a
window."""

import pytest

from conftest import SF001

import __spark_entry__ as entry

from quire import registry

BATCH = sorted(n for n in registry.queries() if not n.startswith("stream_"))


@pytest.fixture()
def static_plans(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins(spark, static_plans, name):
    plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["batch_unique", "dedupe_new", "mirror_upsert", "status_diff"])
def test_hot_keys_not_windowed(spark, static_plans, name):
    plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Window [" not in plan.replace("WindowGroupLimit", "")


@pytest.fixture()
def no_broadcasts(spark, static_plans):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_winners_are_found_on_keys(spark, no_broadcasts):
    """Below the join with the bodies, hashes are summed up before any shuffle
    and no exchange carries a body."""
    from pyspark.sql import functions as F
    from quire.operators import dedupe
    rows = spark.range(100).select(F.col("id").alias("doc_id"), F.concat(F.lit("h"), F.col("id") % 7).alias("hash_code"),
                                  F.concat(F.lit("body"), "id").alias("markdown"))
    keys = dedupe.winner_keys(rows, ("doc_id",), rows.select("hash_code").distinct())
    plan = keys._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    assert "markdown" not in plan and "SortMergeJoin" in plan
    first = max(i for i, x in enumerate(lines) if "Exchange" in x)
    assert any("partial_" in x or "HashAggregate" in x for x in lines[first:])


def test_answers_are_read_once(spark, static_plans):
    plan = entry.queries()["enrich_collapse"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    from quire.operators import enrich
    r = spark.createDataFrame([(1, "score", "{}", None)], "doc_id long, node string, response string, error string")
    once = enrich.decode_answers(r)._jdf.queryExecution().optimizedPlan().toString()
    assert once.count("LogicalRDD") == 1 and plan


def test_url_pattern_is_not_compiled_per_row(spark, static_plans):
    plan = entry.queries()["url_filter"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_instr(" in plan.lower() or "RegExpInStr" in plan


def test_no_cuts_in_the_package():
    """No fixed partition counts, row-count switches, local checkpoints or persists."""
    import os
    import re
    from conftest import ROOT
    bad = re.compile(r"repartition\(\d|localCheckpoint|\.persist\(|\.cache\(|join_small|has_at_most|spread=")
    for d, _, names in os.walk(os.path.join(ROOT, "quire")):
        if os.path.basename(d) == "llm":
            continue
        for n in names:
            if n.endswith(".py"):
                text = open(os.path.join(d, n)).read()
                assert not bad.search(text), (n, bad.search(text))
