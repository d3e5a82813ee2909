"""Incremental ingest and sync-back.

T1 (ingest): new scraped-row files -> per micro-batch: drop empty bodies,
hash, anti-join with the store as it is now, one row per hash, enrich,
append to the store. Dedupe is against all history, so it is a join with
the store rather than streaming ``dropDuplicates`` state (which would grow
without bound). Each micro-batch writes only its own ``run_id`` partition,
so a replayed batch (after a failure) overwrites itself: exactly-once output
with the checkpointed source offsets. The partition's name holds the id of the
stream, so a new stream never replaces another one's rows.

T2 (sync-back): new mirror-pull files -> per micro-batch: decode, validate,
diff against the store's current statuses, append status changes.

Both use ``trigger(availableNow=True)``: process everything present, then
stop; run them on a schedule, or with a processing-time trigger to keep them
running. A long backlog is taken in larger micro-batches, not in more of them:
what a batch costs besides its own rows (its plans, a look at all answers, the
listing of what earlier batches wrote) is paid a bounded number of times.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import CurationConfig
from ..operators import dedupe, enrich, fetch, store
from ..plans import layout
from ..plans.syncback import run_syncback
from ..schemas import SCRAPED

BACKLOG_BATCHES = 8  #: micro-batches of one run, at most, once they hold the least number of files


def batch_files(spark: SparkSession, path: str, least: int) -> int:
    """Files of a micro-batch: ``least``, or as many more as end the files at
    ``path`` (a folder, or a glob of folders) in ``BACKLOG_BATCHES`` batches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/[^_.]*")
    files = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return max(least, -(-len(files or ()) // BACKLOG_BATCHES))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """A short id of the stream that a checkpoint belongs to: the same after a
    restart from it, another one for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"].replace("-", "")[:12]


def ingest_batch(batch: DataFrame, batch_id: int, responses: DataFrame, store_dir: str,
                 cfg: CurationConfig, stream: str = "") -> None:
    """One micro-batch: articles, their hashes, and the rows that were not
    stored with the reason. The batch is computed once: its hashes are read back
    from the written partition, and rows that fail the store's checks are counted
    by that write and computed again only if there are any."""
    spark = batch.sparkSession
    run_id = f"{cfg.run_id}_{stream}b{batch_id:06d}"
    rows = dedupe.hash_urls(fetch.drop_empty_body(batch))
    seen = dedupe.seen_hashes(rows, layout.store_hashes(spark, store_dir, exclude_run=run_id))
    winners, _ = dedupe.batch_unique(rows, ("doc_id",), seen)
    # the reasons need no bodies: of tied rows the least wins, and the body is the last thing to tell two apart
    _, losers = dedupe.batch_unique(rows.select("doc_id", "source_name", "source_url", "article_url", "hash_code"),
                                    ("doc_id",), seen)
    articles = winners.select("doc_id", "hash_code", "article_url", "source_name", "source_url",
                              F.col("markdown").alias("raw_markdown"),
                              F.lit(cfg.run_ts).alias("scraped_at"))
    # the batch's ids go to the answers, which are read but not shuffled for each batch
    out = store.to_store_rows(enrich.enrich(articles, responses, cfg, keys=F.broadcast(batch.select("doc_id"))), cfg) \
        .withColumn("run_id", F.lit(run_id))
    checks = Observation()
    checked = store.flag_rows(out).observe(checks, F.count("reject_reason").alias("bad"))
    layout.write_partition(store.store_columns(checked.where("reject_reason is null")), f"{store_dir}/articles")
    stored = layout.read_or_empty(spark, f"{store_dir}/articles", layout.ARTICLES_SCHEMA) \
        .where(F.col("run_id") == run_id)
    layout.write_batch_hashes(stored.select("hash_code", "unique_id", "run_id"), store_dir)
    reject = ("hash_code", "article_url", "reject_reason")
    rejects = losers.select(*reject)
    if checks.get["bad"]:
        rejects = rejects.unionByName(store.check_rows(out)[1].select(*reject))
    layout.write_partition(rejects.withColumn("run_id", F.lit(run_id)), f"{store_dir}/rejects")


def ingest_stream(spark: SparkSession, scraped_dir: str, responses: DataFrame, store_dir: str,
                  checkpoint: str, cfg: CurationConfig, files_per_batch: int = 1):
    """``files_per_batch``: at least so many files a micro-batch (see ``batch_files``)."""
    files_per_batch = batch_files(spark, scraped_dir, files_per_batch)
    src = (spark.readStream.schema(SCRAPED).option("maxFilesPerTrigger", files_per_batch)
           .parquet(scraped_dir))
    q = (src.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: ingest_batch(df, bid, responses, store_dir, cfg,
                                                    stream_id(spark, checkpoint) + "_"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


PULL_SCHEMA = "page bigint, page_ok boolean, pos bigint, unique_id_cell string, status_cell string"


def syncback_stream(spark: SparkSession, pull_dir: str, store_dir: str, checkpoint: str,
                    changed_at: str, files_per_batch: int = 1):
    """``changed_at`` is when the editors' changes count as made. A new checkpoint
    is a new pull, whose changes stand beside those of earlier ones.
    ``files_per_batch``: at least so many files a micro-batch (see ``batch_files``)."""
    files_per_batch = batch_files(spark, pull_dir, files_per_batch)

    def sync(df: DataFrame, bid: int) -> None:
        pull = f"sync_{stream_id(spark, checkpoint)}"
        run_syncback(df.sparkSession, df, store_dir, changed_at, f"{pull}_b{bid:06d}", pull)

    src = (spark.readStream.schema(PULL_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
           .parquet(pull_dir))
    q = (src.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(sync)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
