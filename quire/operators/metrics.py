"""Per-stage timing and token metrics, run totals, retry decisions.

``attempts`` has one row per timed call (stage, duration_sec, usage JSON,
started_at). Grouping by stage is a hot-key pattern (few stages, all rows);
Spark's partial aggregation folds each map task to one row per stage before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.retry import is_rate_limited, retry_action, retry_wait_sec
from ..functions.usage import add_usage_columns


def with_usage(attempts: DataFrame, usage_col: str = "usage") -> DataFrame:
    return add_usage_columns(attempts, usage_col)


def stage_metrics(attempts: DataFrame) -> DataFrame:
    """stage, count, total_time_sec, avg_time_sec, input/output/total tokens.
    Rows without a duration are token-only records and do not count."""
    a = with_usage(attempts)
    g = a.groupBy("stage").agg(
        F.count("duration_sec").alias("count"),
        F.coalesce(F.sum("duration_sec"), F.lit(0.0)).alias("_t"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("total_tokens").alias("total_tokens"))
    avg = F.when(F.col("count") > 0, F.col("_t") / F.col("count")).otherwise(F.lit(0.0))
    return g.select("stage", "count", F.round("_t", 3).alias("total_time_sec"),
                    F.round(avg, 3).alias("avg_time_sec"), "input_tokens", "output_tokens",
                    "total_tokens")


def stage_rollup(attempts: DataFrame) -> DataFrame:
    """Per-stage rows and the all-stages total (stage NULL) in one pass."""
    a = with_usage(attempts)
    return a.rollup("stage").agg(
        F.count("duration_sec").alias("count"),
        F.round(F.coalesce(F.sum("duration_sec"), F.lit(0.0)), 3).alias("total_time_sec"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("total_tokens").alias("total_tokens"))


def run_totals(attempts: DataFrame) -> DataFrame:
    """One row: stages, calls, token totals and wall clock (first start to
    last end)."""
    a = with_usage(attempts)
    start = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                             F.col("started_at"))
    end = start + (F.col("duration_sec") * 1e6).cast("bigint")
    return a.agg(
        F.count_distinct("stage").alias("stages"),
        F.count("duration_sec").alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
        F.round((F.max(end) - F.min(start)) / 1e6, 3).alias("wall_clock_sec"))


def metrics_json(stage_rows: DataFrame, totals: DataFrame) -> DataFrame:
    """The nested metrics document ({wall_clock_sec, tokens, stages}) as one
    JSON row. ``stage_rows`` has one row per stage name (a handful), so
    gathering them into one map is bounded."""
    st = stage_rows.agg(F.map_from_entries(F.collect_list(F.struct(
        "stage", F.struct("count", "total_time_sec", "avg_time_sec", "input_tokens",
                          "output_tokens", "total_tokens")))).alias("stages"))
    doc = totals.select("wall_clock_sec", F.struct(
        F.col("input_tokens").alias("input"), F.col("output_tokens").alias("output"),
        F.col("total_tokens").alias("total")).alias("tokens"))
    doc = doc.withColumn("stages", st.scalar())
    return doc.select(F.to_json(F.struct("wall_clock_sec", "tokens", "stages")).alias("metrics"))


def retry_plan(errors: DataFrame, max_retries: int = 3, fallback: float = 60.0,
               pad: float = 2.0) -> DataFrame:
    """Per failed call: retry (with a wait) or fail."""
    e, a = F.col("error"), F.col("attempt")
    action = retry_action(e, a, max_retries)
    return errors.select("event_id", "label", "attempt",
                         is_rate_limited(e).alias("rate_limited"), action.alias("action"),
                         F.when(action == "retry", retry_wait_sec(e, fallback, pad))
                         .alias("wait_sec"))
