"""Link discovery: source preparation, per-source URL filtering, the link
cap, the sitemap fallback and per-source counts.

At scale the links table is large and the sources table is small but grows
with the whitelist; how they join is left to the planner, which broadcasts
sources under its byte limit. Per-source caps use ``row_number`` with a
``<= n`` filter, which Spark plans as a partial ``WindowGroupLimit`` before
the shuffle, so a source with a third of all links ships at most ``n`` rows
per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# file/asset URLs that are never articles (case-insensitive,
# optional query string; a fragment after the extension is not matched).
ASSET_URL = r"(?i)\.(pdf|jpe?g|png|gif|svg|webp|mp4|webm|mp3|zip)(?:\?.*)?$"


def prepare_sources(raw: DataFrame) -> DataFrame:
    """Drop sources without a URL; keep name/url/url_pattern."""
    return (raw.where(F.col("url").isNotNull() & (F.col("url") != ""))
            .select("source_id", "name", "url", "url_pattern"))


def is_article_url(url, source_url, pattern) -> "F.Column":
    """The keep predicate of the per-source URL filter (null-safe).

    The pattern is a column. ``regexp_instr`` keeps the compiled pattern until
    its text changes; ``rlike`` on a column compiles it for every row.
    """
    return (url.isNotNull() & (url != "")
            & (F.rtrim(url, F.lit("/")) != F.rtrim(F.coalesce(source_url, F.lit("")), F.lit("/")))
            & ~url.rlike(ASSET_URL)
            & (pattern.isNull() | (pattern == "") | (F.coalesce(F.regexp_instr(url, pattern), F.lit(0)) > 0)))


def with_patterns(links: DataFrame, sources: DataFrame) -> DataFrame:
    """Attach each source's url_pattern and name to its links."""
    src = sources.select("source_id", F.col("name").alias("source_name"), "url_pattern")
    return links.join(src, "source_id")


def flag_kept(links: DataFrame, sources: DataFrame) -> DataFrame:
    j = with_patterns(links, sources)
    return j.withColumn("kept", is_article_url(F.col("url"), F.col("source_url"),
                                               F.col("url_pattern")))


def filter_article_urls(links: DataFrame, sources: DataFrame) -> DataFrame:
    """Links that pass the landing-page, asset and per-source pattern checks
    (order and duplicates are kept)."""
    return flag_kept(links, sources).where("kept").drop("kept")


def limit_links(links: DataFrame, n: int) -> DataFrame:
    """At most ``n`` links per (source, mode), by position."""
    w = Window.partitionBy("source_id", "mode").orderBy("pos", "url")
    return links.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def discover(links: DataFrame, sources: DataFrame, n: int, limit_stage: str = "discover") -> DataFrame:
    """Capped, filtered links. ``limit_stage='discover'`` caps what discovery
    returns (then filters); ``'kept'`` caps what survives the filter."""
    if limit_stage == "discover":
        return filter_article_urls(limit_links(links, n), sources)
    if limit_stage == "kept":
        return limit_links(filter_article_urls(links, sources), n)
    raise ValueError(f"limit_stage must be 'discover' or 'kept', not {limit_stage!r}")


def discover_with_fallback(links: DataFrame, sources: DataFrame, n: int,
                           limit_stage: str = "discover", status: DataFrame | None = None) -> DataFrame:
    """Default-mode links, plus sitemap links for sources whose default
    discovery kept nothing. With ``status`` (source_id, mode, ok), links of a
    failed default call are dropped (the source is skipped) and a failed
    sitemap call contributes nothing.

    The choice is a window over the already-capped links (at most 2n rows
    per source), so no source can bring a large group to one task and the
    capped set is computed once.
    """
    if status is not None:
        ok = status.where("ok").select("source_id", "mode")
        links = links.join(ok, ["source_id", "mode"], "left_semi")
        # the fallback only runs for sources whose default call succeeded
        ok_default = status.where("ok AND mode = 'default'").select("source_id")
        links = links.join(ok_default, "source_id", "left_semi")
    kept = discover(links, sources, n, limit_stage)
    is_default = F.col("mode") == "default"
    has_default = F.max(is_default.cast("int")).over(Window.partitionBy("source_id"))
    return (kept.withColumn("_has_default", has_default)
            .where(is_default | (F.col("_has_default") == 0)).drop("_has_default"))


def discover_counts(links: DataFrame, sources: DataFrame, n: int,
                    limit_stage: str = "discover", status: DataFrame | None = None) -> DataFrame:
    """Per source: links discovered and kept, from the fallback when used.

    With ``status`` (source_id, mode, ok): a source whose default call failed
    has no entry; when the sitemap call failed the fallback is not used and
    the default call's counts stand (zero kept)."""
    # a cap on kept links bounds what is kept, not what was discovered
    capped = limit_links(links, n) if limit_stage == "discover" else links
    flagged = flag_kept(capped, sources)
    d, s = F.col("mode") == "default", F.col("mode") == "sitemap"
    per = flagged.groupBy("source_id").agg(
        F.count_if(d).alias("d_disc"), F.count_if(d & F.col("kept")).alias("d_kept"),
        F.count_if(s).alias("s_disc"), F.count_if(s & F.col("kept")).alias("s_kept"))
    src = sources.select("source_id", "name")
    sitemap_ok = F.lit(True)
    if status is not None:
        ok_default = status.where("ok AND mode = 'default'").select("source_id")
        src = src.join(ok_default, "source_id", "left_semi")
        failed_sitemap = status.where("NOT ok AND mode = 'sitemap'").select(
            "source_id", F.lit(True).alias("_sitemap_failed"))
        src = src.join(failed_sitemap, "source_id", "left")
        sitemap_ok = F.col("_sitemap_failed").isNull()
    per = per.withColumns({c: F.least(F.col(c), F.lit(n).cast("bigint")) for c in ("d_kept", "s_kept")})
    z = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    used = (z("d_kept") == 0) & sitemap_ok
    return (src.join(per, "source_id", "left")
            .select("source_id", "name", used.alias("used_fallback"),
                    F.when(used, z("s_disc")).otherwise(z("d_disc")).alias("discovered"),
                    F.when(used, z("s_kept")).otherwise(z("d_kept")).alias("kept")))
