"""Micro-batches of a backlog: how many there are, and what each leaves behind."""

import glob
import os

from pyspark.sql import functions as F

from conftest import SF001

from quire.config import CurationConfig
from quire.operators import store
from quire.plans import layout
from quire.sources import fixtures as fx
from quire.streaming import incremental


def _parts(path):
    return sorted(os.path.basename(x) for x in glob.glob(f"{path}/run_id=*"))


def test_a_long_backlog_takes_no_more_batches(spark, tmp_dir):
    n = 60
    facts = spark.range(n).select(F.col("id").cast("string").alias("unique_id"), F.lit("seed").alias("run_id"),
                                  F.lit("REVIEWING").alias("status"), F.lit("2026").alias("updated_at"))
    layout.write_partition(facts, f"{tmp_dir}/store/articles")
    pull = spark.range(n).select(F.lit(0).cast("long").alias("page"), F.lit(True).alias("page_ok"), F.col("id").alias("pos"),
                                 F.format_string('"%s"', F.col("id").cast("string")).alias("unique_id_cell"),
                                 F.lit('"READY"').alias("status_cell"), F.col("id").alias("part"))
    pull.write.partitionBy("part").parquet(f"{tmp_dir}/in")
    assert len(glob.glob(f"{tmp_dir}/in/part=*/*.parquet")) == n
    incremental.syncback_stream(spark, f"{tmp_dir}/in/part=*", f"{tmp_dir}/store", f"{tmp_dir}/ckpt", "2026-01-02T00:00:00")
    assert len(_parts(f"{tmp_dir}/store/status_changes")) == 8
    assert layout.current_articles(spark, f"{tmp_dir}/store").where("status = 'READY'").count() == n
    assert incremental.batch_files(spark, f"{tmp_dir}/in/part=*", 4) == 8
    assert incremental.batch_files(spark, f"{tmp_dir}/in/part=*", 50) == 50  # short ones have the size asked for
    assert incremental.batch_files(spark, f"{tmp_dir}/none/part=*", 4) == 4 == incremental.batch_files(spark, f"{tmp_dir}/none", 4)


def test_a_batch_leaves_few_folders_of_hashes(spark, tmp_dir):
    """A later batch lists what earlier ones wrote: not a folder for each prefix."""
    cfg, d = CurationConfig(run_ts="2026-02-01T00:00:00"), f"{tmp_dir}/store"
    rows, answers = fx.scraped(spark, SF001), fx.responses(spark, SF001)
    incremental.ingest_batch(rows.where("doc_id % 2 = 0"), 0, answers, d, cfg)
    incremental.ingest_batch(rows, 1, answers, d, cfg)
    assert len(_parts(f"{d}/article_hashes")) == 2 == len(glob.glob(f"{d}/article_hashes/run_id=*/*/"))
    hashes = spark.read.schema(layout.HASHES_SCHEMA).parquet(f"{d}/article_hashes")
    stored = spark.read.parquet(f"{d}/articles")
    assert hashes.count() == hashes.select("hash_code").distinct().count() == stored.count() > 20
    assert stored.join(hashes, ["hash_code", "unique_id", "run_id"]).count() == stored.count()


def test_rows_that_fail_a_check_are_noted_with_the_reason(spark, tmp_dir, monkeypatch):
    cfg, d = CurationConfig(run_ts="2026-02-01T00:00:00"), f"{tmp_dir}/store"
    rows, answers = fx.scraped(spark, SF001), fx.responses(spark, SF001)
    incremental.ingest_batch(rows, 0, answers, f"{d}0", cfg)
    whole = spark.read.parquet(f"{d}0/articles").select("hash_code", "tag")
    monkeypatch.setattr(store, "TAGS", ("MARKET", "MENTOR"))
    incremental.ingest_batch(rows, 0, answers, f"{d}1", cfg)
    kept = {r.hash_code for r in spark.read.parquet(f"{d}1/articles").collect()}
    assert kept == {r.hash_code for r in whole.where("tag is null or tag in ('MARKET', 'MENTOR')").collect()}
    bad = {r.hash_code for r in spark.read.parquet(f"{d}1/rejects").where("reject_reason = 'bad_tag'").collect()}
    assert bad == {r.hash_code for r in whole.collect()} - kept and bad
