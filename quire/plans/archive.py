"""Archival: articles move from the live facts to an archive partition.

A move is a copy, a manifest and a clean-up. The copies of a move count from
when its manifest is written, and from then on the live rows named there don't,
so a reader (``layout.facts``) sees each article once before, during and after
the move. Every step may be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import layout


def copy(spark: SparkSession, store: str, move_id: str, which: Column) -> None:
    """Copies the live articles whose current state fits ``which`` to the move's archive partition."""
    due = layout.current_articles(spark, store).where(which).select("unique_id")
    live = layout.live_facts(spark, store).join(due, "unique_id", "left_semi")
    layout.write_partition(live.withColumn("move_id", F.lit(move_id)), f"{store}/archive", "move_id")


def commit(spark: SparkSession, store: str, move_id: str) -> None:
    """Writes the move's manifest: its copies are what readers see from now on."""
    copies = _moved_rows(spark, store, move_id)
    layout.write_partition(copies.select("unique_id", "run_id", "move_id"), f"{store}/moves", "move_id")


def clean(spark: SparkSession, store: str, move_id: str) -> None:
    """Takes moved rows out of the runs they came from. What a run keeps is rewritten
    in its partition; a run that keeps nothing stays as files that no reader uses."""
    runs = _moved_rows(spark, store, move_id).select("run_id").distinct()
    rest = layout.live_facts(spark, store).join(runs, "run_id", "left_semi")
    layout.write_partition(rest, f"{store}/articles")


def archive_articles(spark: SparkSession, store: str, move_id: str, which: Column) -> None:
    """Copy, commit and clean. Started again with the same id, a committed move is only cleaned."""
    done = layout.read_or_empty(spark, f"{store}/moves", layout.MOVES_SCHEMA).where(F.col("move_id") == move_id)
    if done.isEmpty():
        copy(spark, store, move_id, which)
        commit(spark, store, move_id)
    clean(spark, store, move_id)


def _moved_rows(spark: SparkSession, store: str, move_id: str) -> DataFrame:
    return layout.read_or_empty(spark, f"{store}/archive", layout.ARCHIVE_SCHEMA).where(F.col("move_id") == move_id)
