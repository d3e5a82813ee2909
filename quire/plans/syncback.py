"""Sync-back: editor status decisions in the review mirror -> store.

Mirror rows are decoded, validated and diffed against the store's current
statuses; the last differing row per id becomes one appended status change.
Unknown ids are ignored; any status transition in the domain is allowed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import mirror
from ..session import shared_path
from . import layout


def run_syncback(spark: SparkSession, pull: DataFrame, store_dir: str, changed_at: str,
                 batch_id: str, pull_id: str | None = None) -> dict:
    """Apply one pull, or one part of the pull ``pull_id``: once a part had a
    failed page, later parts use no page from there on.

    The decoded rows are written once. Counters are observed by the two writes; no job counts again.
    """
    work = shared_path(spark, "quire", "syncback", hashlib.sha1(store_dir.encode()).hexdigest()[:12], batch_id)
    stop = None
    if pull_id is not None:
        stops = layout.read_or_empty(spark, f"{store_dir}/pull_stops", layout.STOPS_SCHEMA)
        mine = stops.where(F.col("run_id").startswith(pull_id + "_") & (F.col("run_id") != batch_id))
        stop = mine.agg(F.min("page")).first()[0]
        if "page_ok" in pull.columns:
            failed = mirror.first_failed_page(pull).where("page is not null")
            layout.write_partition(failed.withColumn("run_id", F.lit(batch_id)), f"{store_dir}/pull_stops")
    pulled, written = Observation(), Observation()
    rejected = F.count("reject_reason").alias("rejected")
    mirror.decode_pull(pull, stop).observe(pulled, rejected).write.mode("overwrite").parquet(f"{work}/decoded")
    decoded = spark.read.parquet(f"{work}/decoded")
    valid = decoded.where(F.col("reject_reason").isNull())
    ids = valid.select("unique_id").distinct()
    cur = layout.current_statuses(spark, store_dir, ids, exclude_change_run=batch_id)
    updates = mirror.status_updates(mirror.status_diff_rows(valid, cur))
    changes = updates.select("unique_id", "new_status", F.lit(changed_at).alias("changed_at"),
                             F.col("pos").alias("seq"), F.lit(batch_id).alias("run_id"))
    applied = F.count(F.lit(1)).alias("applied")
    layout.write_partition(changes.observe(written, applied), f"{store_dir}/status_changes")
    # every update is applied (an update matching no row still counts)
    n = written.get["applied"]
    return {"applied": n, "total": n, "rejected": pulled.get["rejected"]}
