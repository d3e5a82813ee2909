"""Store layout on a shared file system (Parquet, append-only).

    <store>/articles/run_id=<id>/     facts, one partition per run
    <store>/article_hashes/run_id=<id>/prefix=<xx>/  (hash_code, unique_id), narrow, for dedupe,
                                      by the first digits of the hash; those of a micro-batch have none
    <store>/answers/run_id=<id>/prefix=<xx>/  (hash_code, node, response, error) model answers, likewise
    <store>/status_changes/run_id=<id>/  (unique_id, new_status, changed_at, seq)
    <store>/tag_changes/run_id=<id>/     (unique_id, tag, is_clear, changed_at, seq)
    <store>/rejects/run_id=<id>/      rows that were not stored, with the reason
    <store>/runs/run_id=<id>/         (fingerprint) of the runs' inputs and settings
    <store>/pull_stops/run_id=<id>/   (page) where a mirror pull ended
    <store>/archive/move_id=<id>/     facts that were moved out of articles
    <store>/moves/move_id=<id>/       (unique_id, run_id) of committed moves
    <store>/feed_readings/consumer=<c>/reading=<n>/  (sync) which syncs a consumer's reading holds
    <store>/source_sketches/run_id=<id>/  a run's counts and sketches by source
    <mirror>/version=<id>/            review-mirror snapshots
    <mirror>_current/version=<id>/    (published_at) versions that readers may use

Every write replaces only its own ``run_id``/``version`` partition (dynamic
partition overwrite), so a retried run is idempotent and never rewrites a
path another job is reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import store as st
from ..operators.prefixes import PREFIX, prefix_of
from ..schemas import ARTICLE_COLUMNS


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``; empty where it isn't there, or has no file yet."""
    if _exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def write_partition(df: DataFrame, path: str, *parts: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*(parts or ("run_id",))).parquet(path))


HASHES_SCHEMA = "hash_code string, unique_id string, run_id string, prefix string"
ANSWERS_SCHEMA = "hash_code string, node string, response string, error string, run_id string, prefix string"
STATUS_SCHEMA = "unique_id string, new_status string, changed_at string, seq bigint, run_id string"
TAG_SCHEMA = ("unique_id string, tag string, is_clear boolean, changed_at string, seq bigint, "
              "run_id string")
REJECTS_SCHEMA = "hash_code string, article_url string, reject_reason string, run_id string"
RUNS_SCHEMA = "fingerprint string, run_id string"
STOPS_SCHEMA = "page bigint, run_id string"
ARTICLES_SCHEMA = ", ".join(
    f"{c} {'int' if c in ('read_minutes', 'relevance_score', 'quality_score', 'overall_score', 'needs_revision') else 'string'}"
    for c in ARTICLE_COLUMNS) + ", run_id string"
MOVES_SCHEMA = "unique_id string, run_id string, move_id string"
ARCHIVE_SCHEMA = ARTICLES_SCHEMA + ", move_id string"


def live_facts(spark: SparkSession, store: str) -> DataFrame:
    """Facts that no committed move names."""
    live = read_or_empty(spark, f"{store}/articles", ARTICLES_SCHEMA)
    if not _exists(spark, f"{store}/moves"):
        return live
    moved = spark.read.schema(MOVES_SCHEMA).parquet(f"{store}/moves").select("unique_id", "run_id")
    return live.join(moved, ["unique_id", "run_id"], "left_anti").select(live.columns)


def facts(spark: SparkSession, store: str) -> DataFrame:
    """All facts, each once: live ones and those of committed moves."""
    live = live_facts(spark, store)
    if not _exists(spark, f"{store}/moves"):
        return live
    moves = spark.read.schema(MOVES_SCHEMA).parquet(f"{store}/moves").select("move_id").distinct()
    archived = read_or_empty(spark, f"{store}/archive", ARCHIVE_SCHEMA).join(moves, "move_id", "left_semi")
    return live.unionByName(archived.select(live.columns))


def store_hashes(spark: SparkSession, store: str, exclude_run: str | None = None) -> DataFrame:
    """Hashes already stored. ``exclude_run`` leaves out the partition the
    current run is about to (re)write, so a retried run sees the store as it
    was before its first attempt."""
    h = read_or_empty(spark, f"{store}/article_hashes", HASHES_SCHEMA)
    if exclude_run is not None:
        h = h.where(F.col("run_id") != exclude_run)
    return h.select("hash_code", PREFIX)


def write_by_prefix(df: DataFrame, path: str, key: str = "hash_code") -> None:
    """``write_partition`` of a table that is read by prefixes of ``key``: one file a prefix."""
    (df.withColumn(PREFIX, prefix_of(key)).repartition(PREFIX)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", PREFIX).parquet(path))


def write_hashes(df: DataFrame, store: str) -> None:
    """Stored hashes (hash_code, unique_id, run_id) of one run."""
    write_by_prefix(df, f"{store}/article_hashes")


def write_batch_hashes(df: DataFrame, store: str) -> None:
    """Stored hashes of a micro-batch: its files are dealt by no prefix and read always.

    A batch of some thousand hashes meets every prefix anyway, and a folder for
    each of them would be listed again by all later batches."""
    write_partition(df.withColumn(PREFIX, F.lit(None).cast("string")), f"{store}/article_hashes", "run_id", PREFIX)


def write_answers(answers: DataFrame, store: str, run_id: str) -> None:
    """Model answers (hash_code, node, response, error) of one run."""
    write_by_prefix(answers.select("hash_code", "node", "response", "error", F.lit(run_id).alias("run_id")),
                    f"{store}/answers")


def stored_answers(spark: SparkSession, store: str) -> DataFrame:
    """All answers ever given; ``enrich.enrich`` reads the batch's prefixes of them."""
    return read_or_empty(spark, f"{store}/answers", ANSWERS_SCHEMA)


def current_statuses(spark: SparkSession, store: str, ids: DataFrame | None = None,
                     exclude_change_run: str | None = None) -> DataFrame:
    """(unique_id, status) now, optionally only for ``ids``.

    Facts and status changes are narrowed to ``ids`` (semi-joins, which the
    planner broadcasts when the id set is small) before the latest change per
    id is found, so a sync-back batch costs a scan of the narrow columns, not
    a shuffle of the whole store.
    """
    held = facts(spark, store).select("unique_id", "status", "updated_at")
    sc = read_or_empty(spark, f"{store}/status_changes", STATUS_SCHEMA)
    if exclude_change_run is not None:
        sc = sc.where(F.col("run_id") != exclude_change_run)
    if ids is not None:
        held = held.join(ids, "unique_id", "left_semi")
        sc = sc.join(ids, "unique_id", "left_semi")
    return st.apply_status(held, sc).select("unique_id", "status")


def current_articles(spark: SparkSession, store: str,
                     exclude_change_run: str | None = None) -> DataFrame:
    """Facts with the latest status and tag changes applied (optionally
    without the status changes of one run, for idempotent re-runs).

    The facts are read once and joined to the latest change per id."""
    held = facts(spark, store)
    sc = read_or_empty(spark, f"{store}/status_changes", STATUS_SCHEMA)
    if exclude_change_run is not None:
        sc = sc.where(F.col("run_id") != exclude_change_run)
    tc = read_or_empty(spark, f"{store}/tag_changes", TAG_SCHEMA)
    s = st.latest_status(sc).withColumnRenamed("changed_at", "_status_at")
    t = st.latest_tag(tc).withColumnRenamed("changed_at", "_tag_at")
    cur = held.join(s, "unique_id", "left").join(t, "unique_id", "left")
    tag = F.when(F.col("is_clear").isNull(), F.col("tag")).when(~F.col("is_clear"), F.col("new_tag"))
    return cur.withColumns({
        "status": F.coalesce("new_status", "status"), "tag": tag,
        # greatest() skips nulls: a change not made doesn't count
        "updated_at": F.greatest(F.when(F.col("_status_at").isNull() | F.col("_tag_at").isNull(),
                                        F.col("updated_at")), "_status_at", "_tag_at"),
    }).drop("new_status", "_status_at", "new_tag", "is_clear", "_tag_at")


def write_tag_changes(changes: DataFrame, store: str, changed_at: str, batch_id: str) -> None:
    """Append tag edits (unique_id, tag, is_clear, seq); an edit without a tag clears it.

    Tags outside the domain are kept in the table and ignored when it is read."""
    clear = F.coalesce(F.col("is_clear"), F.lit(False)) if "is_clear" in changes.columns else F.lit(False)
    write_partition(changes.select(
        "unique_id", "tag", (clear | F.col("tag").isNull()).alias("is_clear"),
        F.lit(changed_at).alias("changed_at"), F.col("seq").cast("bigint").alias("seq"),
        F.lit(batch_id).alias("run_id")), f"{store}/tag_changes")


PUBLISHED_SCHEMA = "published_at string, version string"


def publish(spark: SparkSession, mirror: str, version: str, published_at: str) -> None:
    """Marks a written snapshot version as the one to read; a version that was never finished isn't seen."""
    write_partition(spark.createDataFrame([(published_at, version)], PUBLISHED_SCHEMA), f"{mirror}_current", "version")


def current_snapshot(spark: SparkSession, mirror: str) -> DataFrame | None:
    """The snapshot that was published last (by time, then name); None before the first."""
    last = read_or_empty(spark, f"{mirror}_current", PUBLISHED_SCHEMA).agg(
        F.max(F.struct("published_at", "version"))["version"]).first()[0]
    return None if last is None else spark.read.parquet(f"{mirror}/version={last}")


TABLES = {"articles": lambda: ARTICLES_SCHEMA, "article_hashes": lambda: HASHES_SCHEMA, "answers": lambda: ANSWERS_SCHEMA,
          "status_changes": lambda: STATUS_SCHEMA, "tag_changes": lambda: TAG_SCHEMA, "rejects": lambda: REJECTS_SCHEMA,
          "runs": lambda: RUNS_SCHEMA, "pull_stops": lambda: STOPS_SCHEMA}


def init_store(spark: SparkSession, store: str) -> None:
    """Writes an empty typed dataset for each table that isn't there, so that any reader finds its schema."""
    for name, schema in TABLES.items():
        if not _exists(spark, f"{store}/{name}"):
            spark.createDataFrame([], schema()).write.mode("ignore").parquet(f"{store}/{name}")


def claim_run(spark: SparkSession, store: str, run_id: str, fingerprint: str) -> None:
    """Note a run's inputs and settings; refuse a run id that stands for others."""
    runs = read_or_empty(spark, f"{store}/runs", RUNS_SCHEMA).where(F.col("run_id") == run_id)
    known = {r.fingerprint for r in runs.limit(2).collect()}   # one row per run
    if known - {fingerprint}:
        raise ValueError(f"run {run_id} is in the store with other inputs or settings; use another run_ts")
    if not known:
        write_partition(spark.createDataFrame([(fingerprint, run_id)], RUNS_SCHEMA), f"{store}/runs")
