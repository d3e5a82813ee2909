"""One ingest run as Spark jobs.

sources + links -> filter/cap/fallback -> fetched bodies -> drop empty ->
hash -> anti-join with the store -> one row per hash -> model enrichment ->
(written once) -> store append, rejects, run snapshot, mirror upsert, metrics.

The enriched rows are written to the shared checkpoint folder before they
fan out to the store, the snapshot and the mirror, so the model stage (or a
responses join) is evaluated exactly once per run and a lost executor only
recomputes from the written table.
"""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import CurationConfig
from ..operators import dedupe, discover, enrich, fetch, metrics, mirror, rounds, store
from ..session import path_done, shared_path
from . import layout


@dataclass
class IngestInputs:
    sources: DataFrame            # source_id, name, url, url_pattern
    links: DataFrame              # source_id, source_url, mode, pos, url
    bodies: DataFrame             # url, html and/or markdown
    responses: DataFrame | None = None   # key, node, response, error
    model_fn: object = None       # or a callable for enrich.infer
    status: DataFrame | None = None      # source_id, mode, ok
    attempts: DataFrame | None = None    # stage, duration_sec, usage, started_at
    mirror_snapshot: DataFrame | None = None
    pause: object = time.sleep    # how the driver waits between rounds of model calls


def input_fingerprint(inp: IngestInputs, cfg: CurationConfig, **options) -> str:
    """A digest of a run's settings and of what it is to fetch.

    Sources, links and discovery outcomes are narrow tables and are summed whole;
    of the bodies the URLs count, so that a restarted run keeps what its first
    attempt fetched.
    """
    def content(df: DataFrame | None) -> str:
        if df is None:
            return "none"
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()
        return f"{sorted(df.columns)} {row[0]} {row[1]}"

    parts = [repr(cfg), repr(sorted(options.items())), repr(inp.model_fn is not None),
             *map(content, (inp.sources, inp.links, inp.status, inp.bodies.select("url")))]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:32]


def run_ingest(spark: SparkSession, inp: IngestInputs, store_dir: str, out_dir: str,
               cfg: CurationConfig, key: str = "hash_code",
               dedupe_before_fetch: bool = False, mirror_snapshot_version: bool = False) -> dict:
    """One run. ``dedupe_before_fetch`` drops already-stored URLs before the
    join with the (wide) bodies table: the identity depends on the URL only,
    so the new rows are the same; the dedupe counters then count links
    rather than fetched bodies. ``mirror_snapshot_version`` also writes the
    whole upserted mirror as a new version (a full rewrite; the pushed
    records alone are always written).

    ``cfg.run_ts`` names the run. The same run may be started again (its
    finished stages are reused); a run id that the store knows with other
    inputs or settings is refused.
    """
    if key != "hash_code":
        raise ValueError("the ingest run keys model answers by hash_code")
    run = cfg.run_id
    fingerprint = input_fingerprint(inp, cfg, dedupe_before_fetch=dedupe_before_fetch)
    layout.claim_run(spark, store_dir, run, fingerprint)
    srcs = discover.prepare_sources(inp.sources)
    kept = discover.discover_with_fallback(inp.links, srcs, cfg.max_links, cfg.limit_stage, inp.status)
    hashes = layout.store_hashes(spark, store_dir, exclude_run=run)
    # per (store, run, inputs): a restarted run finds its own finished stages
    store_key = hashlib.sha1(store_dir.encode()).hexdigest()[:12]
    work = shared_path(spark, "quire", "runs", store_key, run, fingerprint)
    # barrier: the (narrow) links with whether the store holds them already; the
    # link hashes are the same as the fetched rows' hashes
    kept_h = dedupe.hash_urls(kept, "url")
    flagged = dedupe.flag_seen(kept_h, dedupe.seen_hashes(kept_h, hashes))
    links, n_links = _written_once(spark, flagged, f"{work}/links", _DEDUPE_COUNTS)
    if dedupe_before_fetch:
        links = links.where("NOT seen")
    # barrier: the wide fetch join runs once; the enriched rows, rejects and
    # counters all read the written rows (reused when a run is restarted)
    rows = fetch.drop_empty_body(fetch.scrape_join(links, inp.bodies, ("hash_code", "seen")))
    scraped, n_rows = _written_once(spark, rows, f"{work}/fetched", _DEDUPE_COUNTS)
    counted = n_links if dedupe_before_fetch else n_rows
    winners, losers = dedupe.batch_unique(scraped.where("NOT seen").drop("seen"), ("source_id", "pos", "article_url"))
    articles = winners.select("hash_code", "article_url", "source_name", "source_url",
                              F.col("markdown").alias("raw_markdown"),
                              F.lit(cfg.run_ts).alias("scraped_at"))
    articles = articles.withColumn("doc_id", F.col("hash_code"))
    attempts = inp.attempts
    result = {"run_id": run, "store": store_dir, "out": out_dir}
    if inp.model_fn is not None:
        # barrier: every model stage reads the winners
        if not path_done(spark, f"{work}/winners"):
            articles.write.mode("overwrite").parquet(f"{work}/winners")
        articles = spark.read.parquet(f"{work}/winners")
        enriched, answers = enrich.enrich_with_model(articles, inp.model_fn, cfg, f"{work}/model", inp.pause)
        if attempts is None:
            attempts = enrich.model_attempts(answers)
        given_up = rounds.dead_letters(answers).select(F.col("doc_id").alias("hash_code"), "node", "error",
                                                       "attempts", "waited_sec", "reason")
        given_up.write.mode("overwrite").parquet(f"{out_dir}/dead_letters")
        result["dead_letters"] = f"{out_dir}/dead_letters"
    else:
        resp = inp.responses.withColumn("doc_id", F.col(key))
        keys = scraped.select(F.col("hash_code").alias("doc_id"))
        enriched = enrich.enrich(articles, resp, cfg, keys=keys)
    # barrier: the enriched rows are computed once
    enriched.drop("doc_id").write.mode("overwrite").parquet(f"{work}/enriched")
    enriched = spark.read.parquet(f"{work}/enriched")

    rows = store.to_store_rows(enriched, cfg)
    valid, bad = store.check_rows(rows)
    layout.write_partition(store.store_columns(valid), f"{store_dir}/articles")
    layout.write_hashes(valid.select("hash_code", "unique_id", "run_id"), store_dir)
    rejects = (bad.select("hash_code", "article_url", "reject_reason")
               .unionByName(losers.select("hash_code", "article_url", "reject_reason")))
    rejects.write.mode("overwrite").parquet(f"{out_dir}/rejects")
    # run snapshot: every record of the run, whole; those not inserted carry the reason
    unprocessed = losers.withColumnRenamed("markdown", "raw_markdown").select(
        "hash_code", "article_url", "source_name", "source_url", "raw_markdown", "reject_reason")
    snap = (valid.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad)
            .unionByName(unprocessed, allowMissingColumns=True)
            .withColumn("inserted", F.col("reject_reason").isNull()))
    snap.write.mode("overwrite").json(f"{out_dir}/articles")
    if inp.mirror_snapshot is not None:
        # the records to push (updated / created); the mirror itself is not rewritten
        inc = mirror.mirror_fields(store.store_columns(valid), cfg.text_max)
        feed = mirror.upsert_feed(inp.mirror_snapshot, inc)
        feed.write.mode("overwrite").parquet(f"{out_dir}/mirror_changes")
        result["mirror_changes"] = f"{out_dir}/mirror_changes"
        mirror.push_checks(inc)[1].write.mode("overwrite").parquet(f"{out_dir}/mirror_rejects")
        if mirror_snapshot_version:
            path = f"{out_dir}/mirror/version={run}"
            mirror.upsert(inp.mirror_snapshot, inc).write.mode("overwrite").parquet(path)
            layout.publish(spark, f"{out_dir}/mirror", run, cfg.run_ts)
            result["mirror_snapshot"] = path
    if attempts is not None:
        stage_rows = metrics.stage_metrics(attempts)
        metrics.metrics_json(stage_rows, metrics.run_totals(attempts)) \
            .write.mode("overwrite").text(f"{out_dir}/metrics")
    total, skipped = counted["total"], counted["skipped"]
    result.update(total=total, skipped=skipped, new=total - skipped)
    # shape of the scraped table after dropping empty bodies: rows, and its
    # four columns (source_name, source_url, article_url, markdown)
    result["scraped_shape"] = (n_rows["total"], 4)
    return result


_DEDUPE_COUNTS = {"total": "count(1)", "skipped": "count_if(seen)"}


def _written_once(spark: SparkSession, df: DataFrame, path: str, counters: dict) -> tuple[DataFrame, dict]:
    """``df`` written to ``path`` and read again, with ``counters`` observed by that write.

    A folder that a first attempt finished is reused and counted from its files.
    """
    named = [F.expr(c).alias(n) for n, c in counters.items()]
    if path_done(spark, path):
        done = spark.read.parquet(path)
        return done, done.agg(*named).first().asDict()
    seen = Observation()
    df.observe(seen, *named).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), seen.get
