"""Article store: insert rows, constraint checks, keyed status/tag updates.

The store is append-only Parquet: facts partitioned by ``run_id`` plus
append-only change tables (``status_changes``, ``tag_changes``). The current
view is the facts left-joined with the latest change per id; the latest
change is found by aggregation (``max_by`` over the change sequence), which
combines map-side, so an id with very many changes never gathers whole in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import STATUSES, TAGS, CurationConfig
from ..schemas import ARTICLE_COLUMNS


def unique_id(hash_col: Column, run_id: str) -> Column:
    """Row id from (hash, run): stable under task retries, unlike a random id."""
    return F.substring(F.sha2(F.concat(hash_col, F.lit("|"), F.lit(run_id)), 256), 1, 32)


def stage_errors_json(c: str = "stage_errors") -> Column:
    return F.to_json(F.coalesce(F.col(c), F.array().cast("array<struct<node:string,error:string>>")))


def to_store_rows(records: DataFrame, cfg: CurationConfig) -> DataFrame:
    """Processed records -> store rows (all 28 columns, plus run_id and any
    extra key columns the records carry)."""
    ts = F.lit(cfg.run_ts)
    nr = F.col("needs_revision")
    cols = {
        "unique_id": unique_id(F.col("hash_code"), cfg.run_id),
        "status": F.lit("REVIEWING"),
        "needs_revision": F.when(nr.isNull(), F.lit(None).cast("int"))
        .when(nr.cast("boolean"), F.lit(1)).otherwise(F.lit(0)),
        "stage_errors": stage_errors_json(),
        "created_at": ts, "updated_at": ts, "run_id": F.lit(cfg.run_id),
    }
    if "scraped_at" not in records.columns:
        cols["scraped_at"] = ts
    return records.withColumns(cols)


def flag_rows(rows: DataFrame) -> DataFrame:
    """Store rows with ``reject_reason``: the first failed check, null for valid rows."""
    h, s, t, u = F.col("hash_code"), F.col("status"), F.col("tag"), F.col("article_url")
    reason = F.coalesce(
        F.when(h.isNull() | (h == ""), F.lit("missing_hash")),
        F.when(u.isNull(), F.lit("missing_url")),
        F.when(s.isNull() | ~s.isin(*STATUSES), F.lit("bad_status")),
        F.when(t.isNotNull() & ~t.isin(*TAGS), F.lit("bad_tag")))
    return rows.withColumn("reject_reason", reason)


def check_rows(rows: DataFrame):
    """Split store rows into (valid, rejected); rejected rows carry
    ``reject_reason`` (the first failed check). One bad row never stops the
    batch."""
    flagged = flag_rows(rows)
    return (flagged.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            flagged.where(F.col("reject_reason").isNotNull()))


def store_columns(df: DataFrame, *keep: str) -> DataFrame:
    extra = [c for c in ("run_id", *keep) if c in df.columns]
    return df.select(*ARTICLE_COLUMNS, *extra)


def latest_change(changes: DataFrame, value_cols, key: str = "unique_id"):
    """Last change per key (struct of ``value_cols``).

    Changes are ordered by when they were made, then by the sync that brought
    them (``run_id``, where there is one), then by position within it.
    """
    order = [c for c in ("changed_at", "run_id", "seq") if c in changes.columns]
    last = F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.struct(*order))
    return changes.groupBy(key).agg(last.alias("_last")).select(key, "_last.*")


def latest_status(changes: DataFrame) -> DataFrame:
    """``unique_id, new_status, changed_at``; changes outside the domain are ignored."""
    return latest_change(changes.where(F.col("new_status").isin(*STATUSES)), ("new_status", "changed_at"))


def latest_tag(changes: DataFrame) -> DataFrame:
    """``unique_id, new_tag, is_clear, changed_at``; tags outside the domain are ignored."""
    ok = F.col("is_clear") | F.col("tag").isin(*TAGS)
    return latest_change(changes.where(ok).withColumnRenamed("tag", "new_tag"),
                         ("new_tag", "is_clear", "changed_at"))


def apply_status(facts: DataFrame, changes: DataFrame) -> DataFrame:
    """facts (unique_id, status, updated_at) + changes (unique_id, new_status,
    changed_at, run_id, seq) -> current (unique_id, status, updated_at, changed).
    Changes outside the status domain are ignored; unknown ids are no-ops."""
    j = facts.join(latest_status(changes), "unique_id", "left")
    changed = F.col("new_status").isNotNull()
    return j.select("unique_id",
                    F.when(changed, F.col("new_status")).otherwise(F.col("status")).alias("status"),
                    F.when(changed, F.col("changed_at")).otherwise(F.col("updated_at"))
                    .alias("updated_at"),
                    changed.alias("changed"))


def apply_tag(facts: DataFrame, changes: DataFrame) -> DataFrame:
    """facts (unique_id, tag, updated_at) + changes (unique_id, tag, is_clear,
    changed_at, run_id, seq) -> current (unique_id, tag, updated_at, changed).
    A clear sets NULL (it must not fall back to the old tag)."""
    j = facts.join(latest_tag(changes), "unique_id", "left")
    changed = F.col("is_clear").isNotNull()
    return j.select("unique_id",
                    F.when(changed, F.when(~F.col("is_clear"), F.col("new_tag")))
                    .otherwise(F.col("tag")).alias("tag"),
                    F.when(changed, F.col("changed_at")).otherwise(F.col("updated_at"))
                    .alias("updated_at"),
                    changed.alias("changed"))
