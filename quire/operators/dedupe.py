"""Dedupe against the article store and within a batch.

Identity is the SHA-256 of the normalised URL. The store side is a narrow
(hash_code) table. A batch whose keys fit the broadcast threshold probes
the store through a broadcast semi-join (the store is scanned, not
shuffled); otherwise both sides shuffle on the hash, which is uniform on the
store side.

Winners are found on keys alone: one row per hash is summed up before the
shuffle, what is stored already is taken off that narrow table, and the wide
rows join it last. A hash that holds a third of the rows is one row there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import url_hash
from .prefixes import PREFIX, narrowed


def hash_urls(df: DataFrame, url_col: str = "article_url") -> DataFrame:
    return df.withColumn("hash_code", url_hash(url_col))


def seen_hashes(rows: DataFrame, store: DataFrame) -> DataFrame:
    """Distinct hashes of ``rows`` that the store already holds.

    Written as ``store SEMI JOIN batch_keys``: the store grows with every run
    while one run's batch stays comparatively small, so when the planner's
    size estimate of the batch keys is under the broadcast threshold the
    store's narrow hash column is only scanned and probed (never shuffled).
    Beyond it both sides shuffle on the hash, which is uniform. A store with a
    ``prefix`` column is read only in the partitions of the batch's hashes.
    """
    narrow = store.select("hash_code", *(c for c in store.columns if c == PREFIX))
    return narrowed(narrow, rows, "hash_code").select("hash_code").distinct()


def dedupe_new(rows: DataFrame, store: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Rows whose hash is not in the store, whatever the stored status.

    ``seen`` (hashes already stored, from ``seen_hashes``) may be computed
    from a cheaper table with the same hashes, e.g. the links before fetch,
    so the batch itself is computed once.
    """
    if seen is None:
        seen = seen_hashes(rows, store)
    return rows.join(seen, "hash_code", "left_anti")


def flag_seen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """``rows`` with ``seen``: whether the store holds their hash already. For narrow rows."""
    held = seen.select("hash_code", F.lit(True).alias("seen"))
    return rows.join(held, "hash_code", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


def existing_hashes(rows: DataFrame, store: DataFrame) -> DataFrame:
    """Distinct non-blank hashes of ``rows`` that the store already has."""
    h = rows.select("hash_code").where((F.col("hash_code") != "") & F.col("hash_code").isNotNull())
    return seen_hashes(h, store)


def dedupe_counts(rows: DataFrame, store: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """total / skipped / new over the batch (one row)."""
    per_hash = rows.groupBy("hash_code").agg(F.count(F.lit(1)).alias("n"))
    if seen is None:
        seen = seen_hashes(rows, store)
    seen = seen.withColumn("seen", F.lit(True))
    j = per_hash.join(seen, "hash_code", "left")
    return j.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
                 F.coalesce(F.sum(F.when(F.col("seen"), F.col("n"))), F.lit(0)).cast("bigint")
                 .alias("skipped")).withColumn("new", F.col("total") - F.col("skipped"))


def winner_keys(rows: DataFrame, order_cols=("doc_id",), seen: DataFrame | None = None) -> DataFrame:
    """``hash_code, _win, _ties``: the smallest ``order_cols`` of each hash that
    is not in ``seen``, and how many rows share it."""
    key = F.struct(*order_cols)
    keys = rows.groupBy("hash_code", key.alias("_win")).agg(F.count(F.lit(1)).alias("_ties"))
    win = keys.groupBy("hash_code").agg(F.min(F.struct("_win", "_ties")).alias("_w"))
    win = win.select("hash_code", "_w.*")
    return win if seen is None else win.join(seen, "hash_code", "left_anti")


def batch_unique(rows: DataFrame, order_cols=("doc_id",), seen: DataFrame | None = None):
    """Split a batch into (winners, losers): one winner per hash, the smallest
    ``order_cols``; losers carry ``reject_reason='duplicate_hash'``.

    With ``seen``, rows whose hash is stored already are in neither. Rows that
    tie on ``order_cols`` are told apart by all their columns, so one wins even
    among equal rows. Rows without a hash lose with ``missing_hash``.
    """
    cols = rows.columns
    j = rows.join(winner_keys(rows, order_cols, seen), "hash_code")
    j = j.withColumn("_first", F.struct(*order_cols).eqNullSafe(F.col("_win")))
    whole = F.struct(*cols)
    best = j.where("_first").groupBy("hash_code").agg(F.min(whole).alias("_best"))
    winners = best.select("_best.*").select(cols)
    tied = j.where("_first AND _ties > 1").groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    tied = tied.join(best, "hash_code").withColumn(
        "_n", F.col("_n") - whole.eqNullSafe(F.col("_best")).cast("int")).where("_n > 0")
    # equal rows are listed again in steps, so that no array grows with their number
    tied = tied.withColumn("_from", F.explode(F.expr("sequence(0, _n - 1, 1000)")))
    tied = tied.withColumn("_k", F.explode(F.expr("sequence(_from, least(_from + 999, _n - 1))")))
    losers = j.where("NOT _first").select(cols).unionByName(tied.select(cols))
    losers = losers.withColumn("reject_reason", F.lit("duplicate_hash")).unionByName(
        rows.where(F.col("hash_code").isNull()).withColumn("reject_reason", F.lit("missing_hash")))
    return winners, losers
