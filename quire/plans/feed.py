"""Change feed: articles that became READY, once for each consumer.

A consumer reads in numbered readings. A reading first notes the syncs that no
earlier reading of the consumer holds; its rows follow from those syncs, so a
reading that is asked for again gives the same transitions, and each sync's
changes belong to one reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import layout

READINGS_SCHEMA = "sync string, consumer string, reading string"
ARTICLE_FIELDS = ("article_url", "title_en", "title_zh", "tag")


def open_reading(spark: SparkSession, store: str, consumer: str, reading: str) -> None:
    """Notes the syncs of a reading; one that is open already keeps its syncs."""
    path = f"{store}/feed_readings"
    held = layout.read_or_empty(spark, path, READINGS_SCHEMA).where(F.col("consumer") == consumer)
    if held.where(F.col("reading") == reading).isEmpty():
        syncs = layout.read_or_empty(spark, f"{store}/status_changes", layout.STATUS_SCHEMA).select(
            F.col("run_id").alias("sync")).distinct()
        mine = syncs.join(held, "sync", "left_anti").select(
            "sync", F.lit(consumer).alias("consumer"), F.lit(reading).alias("reading"))
        # an empty row holds the place of a reading without syncs
        none = spark.createDataFrame([(None, consumer, reading)], READINGS_SCHEMA)
        (mine.unionByName(none).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("consumer", "reading").parquet(path))


def read_feed(spark: SparkSession, store: str, consumer: str, reading: str, status: str = "READY") -> DataFrame:
    """``unique_id, sync, changed_at, previous_status`` and article fields: the reading's
    transitions into ``status``.

    A change counts if the article had another status before it, in order of
    time, sync and position. Only articles with a change in the reading are
    looked at.
    """
    open_reading(spark, store, consumer, reading)
    mine = layout.read_or_empty(spark, f"{store}/feed_readings", READINGS_SCHEMA).where(
        (F.col("consumer") == consumer) & (F.col("reading") == reading)).select("sync")
    changes = layout.read_or_empty(spark, f"{store}/status_changes", layout.STATUS_SCHEMA).withColumnRenamed("run_id", "sync")
    ids = changes.join(mine, "sync", "left_semi").select("unique_id").distinct()
    facts = layout.facts(spark, store).join(ids, "unique_id", "left_semi")
    order = Window.partitionBy("unique_id").orderBy("changed_at", "sync", "seq")
    history = (changes.join(ids, "unique_id", "left_semi")
               .join(facts.select("unique_id", F.col("status").alias("_first"), *ARTICLE_FIELDS), "unique_id")
               .withColumn("previous_status", F.coalesce(F.lag("new_status").over(order), "_first")))
    return (history.where((F.col("new_status") == status) & (F.col("previous_status") != status))
            .join(mine, "sync", "left_semi")
            .select("unique_id", "sync", "changed_at", "previous_status", *ARTICLE_FIELDS))
