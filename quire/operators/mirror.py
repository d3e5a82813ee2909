"""Review mirror: field projection, keyed upsert, status pull.

The mirror is a snapshot table (one row per review record). An upsert by
``unique_id`` updates the first matching record (by position) and creates
the rest; omitted (NULL) cells leave the stored cell unchanged, except the
title, the revision flag and the error list, which are always written.
Bulk joins replace the per-record lookups of a remote API.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import STATUSES, TAGS
from ..functions import text as tx
from ..functions.richtext import rich_text, status_text
from ..functions.timeparse import clean_datetime_text, epoch_ms_from_clean
from ..schemas import (MIRROR_DATE_FIELDS, MIRROR_FIELDS, MIRROR_NUMBER_FIELDS,
                       MIRROR_TEXT_FIELDS)
from ..session import shared_dir
from .store import stage_errors_json

FIELD_NAMES = tuple(n for n, _ in MIRROR_FIELDS)
ALWAYS_WRITTEN = ("title_zh", "needs_revision", "stage_errors")


def mirror_fields(records: DataFrame, text_max: int = 1900, tz: str = "UTC") -> DataFrame:
    """Records (store rows) -> the 26 mirror cells; NULL means omitted."""
    # cleaned datetime text first, in its own projection (keeps each
    # generated expression small)
    records = records.withColumns({f"_dt_{k}": clean_datetime_text(F.col(k))
                                   for k in MIRROR_DATE_FIELDS})
    cols = {"title_zh": tx.truncate_text(tx.title_fallback(F.col("title_zh"),
                                                           F.col("article_url")), text_max)}
    for k in MIRROR_TEXT_FIELDS:
        v = F.col(k).cast("string")
        cols[k] = F.when(v != "", tx.truncate_text(v, text_max))
    cols["status"] = tx.select_value(F.col("status"), STATUSES)
    cols["tag"] = tx.select_value(F.col("tag"), TAGS)
    cols["article_url"] = tx.url_value(F.col("article_url"))
    cols["source_url"] = tx.url_value(F.col("source_url"))
    for k in MIRROR_DATE_FIELDS:
        cols[k] = epoch_ms_from_clean(F.col(f"_dt_{k}"), tz)
    for k in MIRROR_NUMBER_FIELDS:
        cols[k] = tx.number_value(F.col(k))
    cols["needs_revision"] = F.coalesce(F.col("needs_revision").cast("boolean"), F.lit(False))
    errs = F.col("stage_errors")
    if dict(records.dtypes).get("stage_errors", "string").startswith("array"):
        errs = stage_errors_json()
    cols["stage_errors"] = tx.truncate_text(F.coalesce(errs, F.lit("[]")), text_max)
    return records.select(*[cols[n].alias(n) for n in FIELD_NAMES])


def push_checks(increment: DataFrame):
    """Records to push -> (with an id, those without one and ``reject_reason``)."""
    has_id = F.coalesce(F.col("unique_id") != "", F.lit(False))
    return increment.where(has_id), increment.where(~has_id).withColumn("reject_reason", F.lit("missing_unique_id"))


def _at_first(snapshot: DataFrame, increment: DataFrame) -> DataFrame:
    """Increment cells (``_i_<name>``) with ``_pos``: the position of the first
    record of the same id, null if there is none. Rows without an id are left out (see ``push_checks``).

    First positions are found on two narrow columns; the increment is used once.
    """
    inc = push_checks(increment)[0]
    inc = inc.select(*[F.col(n).alias(f"_i_{n}") for n in FIELD_NAMES])
    firsts = (snapshot.select(F.col("unique_id").alias("_i_unique_id"), "record_pos")
              .where("_i_unique_id is not null")
              .groupBy("_i_unique_id").agg(F.min("record_pos").alias("_pos")))
    return inc.join(firsts, "_i_unique_id", "left")


def _merged(j: DataFrame) -> DataFrame:
    """Record columns and ``action`` of snapshot records joined to increment cells."""
    has_snap, has_inc = F.col("record_id").isNotNull(), F.col("_i_unique_id").isNotNull()
    out = []
    for n in FIELD_NAMES:
        s, i = F.col(n), F.col(f"_i_{n}")
        v = i if n in ALWAYS_WRITTEN else F.coalesce(i, s)
        out.append(F.when(has_inc, v).otherwise(s).alias(n))
    action = (F.when(has_snap & has_inc, F.lit("updated"))
              .when(has_inc, F.lit("created")).otherwise(F.lit("unchanged")))
    rid = F.coalesce(F.col("record_id"), F.concat(F.lit("new-"), F.col("_i_unique_id")))
    return j.select(rid.alias("record_id"), F.col("record_pos"), *out, action.alias("action"))


def upsert(snapshot: DataFrame, increment: DataFrame) -> DataFrame:
    """New snapshot with an ``action`` column: unchanged / updated / created.

    ``snapshot``: record_id, record_pos, 26 cells. ``increment``: 26 cells, one
    row per id. Increment rows without unique_id are skipped.

    Only the first record of an id is updated, so records and increment join
    once, on id and position: records that share an id spread by position, and
    no task gathers them.
    """
    inc = _at_first(snapshot, increment)
    j = snapshot.join(inc, (F.col("unique_id") == F.col("_i_unique_id"))
                      & (F.col("record_pos") == F.col("_pos")), "full_outer")
    return _merged(j)


def upsert_feed(snapshot: DataFrame, increment: DataFrame) -> DataFrame:
    """Only the records an upsert touches (action updated / created), with
    their new cells: what is pushed to the review table.

    The increment is computed once, into a checkpoint that also holds each id's
    first position; the mirror is read for those positions and for the cells of
    the records found, never rewritten.
    """
    shared_dir(snapshot.sparkSession)
    inc = _at_first(snapshot, increment).checkpoint()
    found = snapshot.join(inc, (F.col("unique_id") == F.col("_i_unique_id"))
                          & (F.col("record_pos") == F.col("_pos")))
    fresh = inc.where(F.col("_pos").isNull()).withColumns(
        {c.name: F.lit(None).cast(c.dataType) for c in snapshot.schema.fields})
    return _merged(found).unionByName(_merged(fresh))


def first_failed_page(pull: DataFrame) -> DataFrame:
    """One row, ``page``: the first failed page, null when every page is ok."""
    return pull.where(~F.col("page_ok")).agg(F.min("page").alias("page"))


def decode_pull(pull: DataFrame, stop_page: int | None = None) -> DataFrame:
    """Mirror rows -> pos, unique_id, status, reject_reason (null for a valid status).

    Only pages before the first failed page are used (a failed page ends the
    scan), and before ``stop_page``, where an earlier part of the same pull
    ended; blank ids or statuses are skipped; statuses outside the domain go
    to quarantine.
    """
    rows = pull
    if "page_ok" in pull.columns:
        # scalar subquery: the first failed page (NULL when every page is ok)
        fail = first_failed_page(pull).scalar()
        rows = pull.where(fail.isNull() | (F.col("page") < fail))
    if stop_page is not None:
        rows = rows.where(F.col("page") < stop_page)
    x = rows.select("pos", rich_text("unique_id_cell").alias("unique_id"),
                    status_text("status_cell").alias("status"))
    blank = (F.col("unique_id") == "") | (F.col("status") == "")
    bad = ~F.col("status").isin(*STATUSES)
    reason = F.when(blank, F.lit("blank")).when(bad, F.lit("invalid_status"))
    return x.withColumn("reject_reason", reason)


def pull_statuses(pull: DataFrame, stop_page: int | None = None):
    """Mirror rows -> (valid, quarantined) statuses."""
    x = decode_pull(pull, stop_page)
    return (x.where(F.col("reject_reason").isNull()).drop("reject_reason"),
            x.where(F.col("reject_reason").isNotNull()))


def status_diff_rows(valid: DataFrame, store: DataFrame) -> DataFrame:
    """Every mirror row whose status differs from the store; unknown ids
    are ignored."""
    s = store.select("unique_id", F.col("status").alias("old_status"))
    j = valid.join(s, "unique_id")
    return j.where(F.col("status") != F.col("old_status")).select(
        "pos", "unique_id", "old_status", F.col("status").alias("new_status"))


def status_updates(diff_rows: DataFrame) -> DataFrame:
    """One update per id: the last differing row by position wins."""
    last = F.max_by(F.struct("new_status", "pos"), F.col("pos"))
    return (diff_rows.groupBy("unique_id", "old_status").agg(last.alias("_l"))
            .select("unique_id", "old_status", F.col("_l.new_status").alias("new_status"),
                    F.col("_l.pos").alias("pos")))
