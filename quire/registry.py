"""Named queries over a test-data folder: each is ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (through the fixture derivations in
``quire.sources.fixtures``) and runs the library operators over all rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import CurationConfig
from .operators import dedupe, discover, fetch
from .operators import enrich as en
from .operators import metrics as mt
from .operators import mirror as mi
from .operators import dashboard, rounds, semantic
from .operators import schema_check as sc
from .operators import store as st
from .schemas import EXTRACT_FIELDS
from .session import tune
from .sources import fixtures as fx
from .sources.tables import load

RUN_TS = "2026-01-01T00:00:00"
CFG = CurationConfig(run_ts=RUN_TS)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


# discovery -------------------------------------------------------------------
LINK_COLS = ("source_id", "source_name", "mode", "pos", "url")


@query
def source_prepare(spark, d):
    return discover.prepare_sources(fx.sources(spark, d))


@query
def sources_incomplete(spark, d):
    """Entries without a URL are dropped; those without a name stay."""
    return discover.prepare_sources(fx.incomplete_sources(spark, d))


@query
def url_filter(spark, d):
    return discover.filter_article_urls(fx.links(spark, d), fx.sources(spark, d)).select(*LINK_COLS)


@query
def discover_limit(spark, d):
    return discover.discover(fx.links(spark, d), fx.sources(spark, d), CFG.max_links,
                             "discover").select(*LINK_COLS)


@query
def discover_kept_limit(spark, d):
    return discover.discover(fx.links(spark, d), fx.sources(spark, d), CFG.max_links,
                             "kept").select(*LINK_COLS)


@query
def discover_with_fallback(spark, d):
    return discover.discover_with_fallback(fx.links(spark, d), fx.sources(spark, d),
                                           CFG.max_links).select(*LINK_COLS)


@query
def discover_counts(spark, d):
    return discover.discover_counts(fx.links(spark, d), fx.sources(spark, d), CFG.max_links)


@query
def discover_with_status(spark, d):
    """Fallback discovery when some discovery calls failed."""
    return discover.discover_with_fallback(fx.links(spark, d), fx.sources(spark, d), CFG.max_links,
                                           status=fx.discovery_status(spark, d)).select(*LINK_COLS)


@query
def discover_counts_status(spark, d):
    return discover.discover_counts(fx.links(spark, d), fx.sources(spark, d), CFG.max_links,
                                    status=fx.discovery_status(spark, d))


# fetch -----------------------------------------------------------------------
def _kept_links(spark, d):
    return discover.discover_with_fallback(fx.links(spark, d), fx.sources(spark, d), CFG.max_links)


@query
def scrape_join(spark, d):
    s = fetch.scrape_join(_kept_links(spark, d), load(spark, d, "pages", "url", "html"))
    return s.select("source_id", "pos", "source_name", "source_url", "article_url",
                    F.sha2(F.coalesce("markdown", F.lit("<null>")), 256).alias("markdown_sha"),
                    F.length("markdown").alias("markdown_chars"))


@query
def drop_empty_body(spark, d):
    return fetch.drop_empty_body(fx.scraped(spark, d)).select(
        "doc_id", "source_name", "source_url", "article_url",
        F.length("markdown").alias("markdown_chars"))


@query
def page_text(spark, d):
    t = fetch.page_text(load(spark, d, "pages", "page_id", "html"))
    return t.select("page_id", F.sha2("text", 256).alias("text_sha"), "n_chars")


@query
def page_markdown(spark, d):
    """Each page's Markdown: its digest, and how many headings and links it has."""
    t = fetch.bodies_as_markdown(load(spark, d, "pages", "page_id", "html"))
    return t.select("page_id", F.sha2("markdown", 256).alias("markdown_sha"), F.length("markdown").alias("n_chars"),
                    F.regexp_count("markdown", F.lit("(?m)^#{1,6} ")).alias("n_headings"),
                    F.regexp_count("markdown", F.lit(r"\]\([^)]*\)")).alias("n_links"))


# dedupe ----------------------------------------------------------------------
def _fresh_rows(spark, d):
    """Scraped rows with a body, hashed."""
    return dedupe.hash_urls(fetch.drop_empty_body(fx.scraped(spark, d)))


@query
def hash_urls(spark, d):
    return dedupe.hash_urls(fx.links(spark, d), "url").select("source_id", "pos", "url",
                                                               "hash_code")


def _seen(spark, d):
    """Stored hashes among the scraped URLs (probe keys from the URLs alone:
    a superset of the batch's hashes, so the anti-join is the same and the
    bodies are not read twice)."""
    urls = dedupe.hash_urls(fx.scraped(spark, d).select("article_url"))
    return dedupe.seen_hashes(urls, fx.store(spark, d))


@query
def dedupe_new(spark, d):
    return dedupe.dedupe_new(_fresh_rows(spark, d), None, _seen(spark, d)).select(
        "doc_id", "article_url", "hash_code")


@query
def existing_hashes(spark, d):
    return dedupe.existing_hashes(_fresh_rows(spark, d), fx.store(spark, d))


@query
def dedupe_counts(spark, d):
    return dedupe.dedupe_counts(_fresh_rows(spark, d), None, _seen(spark, d))


def _new_unique(spark, d):
    return dedupe.batch_unique(_fresh_rows(spark, d), ("doc_id",), _seen(spark, d))


@query
def batch_unique(spark, d):
    winners, losers = _new_unique(spark, d)
    return (winners.select("doc_id", "hash_code", F.lit(True).alias("kept"))
            .unionByName(losers.select("doc_id", "hash_code", F.lit(False).alias("kept"))))


@query
def ingest_duplicate_bodies(spark, d):
    """Every link twice, every page body three times (once cut short): one
    article per hash, from the whole body."""
    pages = load(spark, d, "pages", "url", "html")
    short = pages.withColumn("html", F.expr("substring(html, 1, length(html) div 2)"))
    rows = fetch.scrape_join(fx.links(spark, d).join(fx.sources(spark, d).select(
        "source_id", F.col("name").alias("source_name")), "source_id"),
        short.unionByName(pages).unionByName(pages))
    rows = dedupe.hash_urls(fetch.drop_empty_body(rows))
    winners, _ = dedupe.batch_unique(rows.unionByName(rows), ("source_id", "pos", "article_url"))
    return winners.select("hash_code", "source_id", "pos", "article_url",
                          F.sha2("markdown", 256).alias("markdown_sha"))


# enrichment --------------------------------------------------------------------

CFG_ACC = CurationConfig(run_ts=RUN_TS, on_missing_excerpt="accumulate")
ENRICHED_COLS = ("doc_id", "hash_code", *EXTRACT_FIELDS, "tag", "tag_reason", "relevance_score",
                 "quality_score", "overall_score", "reason", "needs_revision", "review_notes")


def _articles(spark, d, cfg=CFG):
    winners, _ = _new_unique(spark, d)
    return winners.select("doc_id", "hash_code", "article_url", "source_name", "source_url",
                          F.col("markdown").alias("raw_markdown"),
                          F.lit(cfg.run_ts).alias("scraped_at"))


def _enriched(spark, d, cfg=CFG):
    return en.enrich(_articles(spark, d, cfg), fx.repeated_answers(spark, d), cfg)


def _enriched_out(df):
    return df.select(*ENRICHED_COLS, st.stage_errors_json().alias("stage_errors"),
                     en.error_nodes().alias("error_nodes"))


@query
def enrich_collapse(spark, d):
    return _enriched_out(_enriched(spark, d, CFG))


@query
def enrich_accumulate(spark, d):
    return _enriched_out(_enriched(spark, d, CFG_ACC))


def _prompt_out(df, prompt, node):
    return df.select("doc_id", F.sha2(prompt, 256).alias("prompt_sha"),
                     F.length(prompt).alias("prompt_chars"),
                     F.sha2(en.system_message(F.lit(node)), 256).alias("system_sha"))


@query
def requests_extract(spark, d):
    a = _articles(spark, d)
    return _prompt_out(a, en.extract_request(a), "extract")


@query
def requests_score(spark, d):
    a = _articles(spark, d)
    return _prompt_out(a, en.score_request(a), "score")


def _after_extract(spark, d):
    """Articles whose extract answer is valid, with the decoded fields."""
    ok = en.valid_only(en.decode_answers(fx.repeated_answers(spark, d), nodes=("extract",)), "ex_err")
    return _articles(spark, d).join(ok, "doc_id")


@query
def requests_tag(spark, d):
    return _prompt_out(_after_extract(spark, d), en.tag_request(), "generate_tag")


@query
def requests_review(spark, d):
    return _prompt_out(_after_extract(spark, d), en.review_request(), "review")


def _decoded(spark, d, node):
    x = en.decode_responses(fx.responses(spark, d), node)
    p = en.PREFIX[node]
    names = [f for f, _ in en.FIELDS[node]] + (["overall_score"] if node == "score" else [])
    return x.select("doc_id", *[F.col(f"{p}_{f}").alias(f) for f in names],
                    F.col(f"{p}_err").alias("error"))


@query
def decode_extract(spark, d):
    return _decoded(spark, d, "extract")


@query
def decode_score(spark, d):
    return _decoded(spark, d, "score")


@query
def decode_tag(spark, d):
    return _decoded(spark, d, "generate_tag")


@query
def decode_review(spark, d):
    return _decoded(spark, d, "review")


# store -------------------------------------------------------------------------
def _store_split(spark, d):
    rows = st.to_store_rows(_enriched(spark, d), CFG)
    return st.check_rows(rows)


@query
def store_rows(spark, d):
    valid, _ = _store_split(spark, d)
    return st.store_columns(valid, "doc_id")


@query
def store_rejects(spark, d):
    _, bad = _store_split(spark, d)
    _, losers = _new_unique(spark, d)
    return (bad.select("doc_id", "hash_code", "reject_reason")
            .unionByName(losers.select("doc_id", "hash_code", "reject_reason")))


@query
def store_checks(spark, d):
    """Every check of a store row, failed by some documents."""
    valid, bad = st.check_rows(fx.unchecked_rows(spark, d))
    return (valid.select("doc_id", F.lit(None).cast("string").alias("reject_reason"))
            .unionByName(bad.select("doc_id", "reject_reason")))


@query
def short_ids(spark, d):
    from .functions.text import short_id
    return fx.store(spark, d).select("unique_id", short_id("hash_code").alias("short_hash"))


# mirror --------------------------------------------------------------------------
def _flat(df):
    """Mirror cells with the url pairs split into plain columns."""
    out = []
    for c in df.columns:
        if c in ("article_url", "source_url"):
            out += [F.col(f"{c}.link").alias(f"{c}_link"), F.col(f"{c}.text").alias(f"{c}_text")]
        else:
            out.append(F.col(c))
    return df.select(*out)


def _increment(spark, d):
    valid, _ = _store_split(spark, d)
    return mi.mirror_fields(st.store_columns(valid), CFG.text_max)


@query
def mirror_fields(spark, d):
    return _flat(_increment(spark, d))


def _upserted(spark, d):
    return mi.upsert(fx.mirror_snapshot(spark, d, CFG.run_id), _increment(spark, d))


@query
def mirror_upsert(spark, d):
    return _flat(_upserted(spark, d))


@query
def mirror_actions(spark, d):
    """The pushed records only (no full mirror rewrite)."""
    feed = mi.upsert_feed(fx.mirror_snapshot(spark, d, CFG.run_id), _increment(spark, d))
    return _flat(feed)


# sync-back -------------------------------------------------------------------------
SYNC_TS = "2026-01-02T00:00:00"


@query
def push_rejects(spark, d):
    """Records whose id is blank or missing are not pushed, and are kept with the reason."""
    first = F.substring("hash_code", 1, 1)
    inc = _increment(spark, d).withColumn(
        "unique_id", F.when(first == "0", F.lit("")).when(first != "1", F.col("unique_id")))
    pushed, rejected = mi.push_checks(inc)
    return (rejected.select("hash_code", "reject_reason")
            .unionByName(pushed.select("hash_code", F.lit(None).cast("string").alias("reject_reason"))))


@query
def rich_text(spark, d):
    from .functions.richtext import rich_text as rt, status_text
    p = fx.mirror_pull(spark, d)
    return p.select("pos", rt("unique_id_cell").alias("unique_id"),
                    status_text("status_cell").alias("status"))


def _diff_rows(spark, d):
    valid, _ = mi.pull_statuses(fx.mirror_pull(spark, d))
    return mi.status_diff_rows(valid, fx.review_store(spark, d))


@query
def status_diff_rows(spark, d):
    return _diff_rows(spark, d)


@query
def status_diff(spark, d):
    return mi.status_updates(_diff_rows(spark, d)).drop("pos")


@query
def status_rejects(spark, d):
    _, bad = mi.pull_statuses(fx.mirror_pull(spark, d))
    return bad


@query
def status_failed_page(spark, d):
    """The scan ends at the first failed page."""
    valid, bad = mi.pull_statuses(fx.failed_pull(spark, d))
    return valid.select("pos", "status").unionByName(bad.select("pos", "status"))


@query
def status_paged_reader(spark, d):
    """The same pull read from page files: the first page that can't be read ends it."""
    from .sources.pages import read_mirror_pages, write_mirror_pages
    path = _work_dir(spark, "pages")
    write_mirror_pages(fx.failed_pull(spark, d), path)
    valid, bad = mi.pull_statuses(read_mirror_pages(spark, path))
    return valid.select("pos", "status").unionByName(bad.select("pos", "status"))


@query
def status_apply(spark, d):
    facts = fx.review_store(spark, d).select("unique_id", "status",
                                      F.lit(CFG.run_ts).alias("updated_at"))
    changes = mi.status_updates(_diff_rows(spark, d)).select(
        "unique_id", "new_status", F.lit(SYNC_TS).alias("changed_at"), F.col("pos").alias("seq"))
    return st.apply_status(facts, changes)


@query
def tag_apply(spark, d):
    return st.apply_tag(fx.store_tags(spark, d), fx.tag_changes(spark, d))


@query
def schema_diff(spark, d):
    rows, types = fx.legacy_mirror(spark, d)
    return sc.schema_diff(sc.expected_fields(spark), sc.listed_fields(rows, types))


# metrics ---------------------------------------------------------------------------
@query
def token_usage(spark, d):
    a = mt.with_usage(fx.attempts(spark, d))
    return a.select("event_id", "stage", "input_tokens", "output_tokens", "total_tokens")


@query
def stage_metrics(spark, d):
    return mt.stage_metrics(fx.attempts(spark, d))


@query
def stage_rollup(spark, d):
    return mt.stage_rollup(fx.attempts(spark, d))


@query
def run_totals(spark, d):
    return mt.run_totals(fx.attempts(spark, d))


@query
def retry_plan(spark, d):
    return mt.retry_plan(fx.error_log(spark, d), CFG.max_retries, CFG.fallback_sleep_sec,
                         CFG.extra_pad_sec)


@query
def model_rounds(spark, d):
    """One call for each document to a model that fails by schedule: rate-limited
    calls are asked again until they are answered or given up."""
    asked = load(spark, d, "documents", "doc_id").select(
        "doc_id", F.lit("score").alias("node"), F.lit("p").alias("prompt"))
    answers = rounds.ask_in_rounds(
        asked, lambda r: en.infer(r, fx.failing_model), ("doc_id", "node"), _work_dir(spark, "rounds"),
        CFG.max_retries, CFG.fallback_sleep_sec, CFG.extra_pad_sec, pause=lambda sec: None)
    dead = rounds.dead_letters(answers).select("doc_id", "reason")
    return answers.join(dead, "doc_id", "left").select(
        "doc_id", "response", "error", "attempts", "waited_sec", "reason")


@query
def source_dashboard(spark, d):
    """Dashboards from kept sketches, and whether their estimates are as near to
    the calls as the sketches promise: 5 % of a distinct count, 2 % of ranks."""
    from .plans import layout
    calls, base = fx.fetch_calls(spark, d), _work_dir(spark, "dashboard")
    layout.write_partition(dashboard.source_sketches(calls), f"{base}/source_sketches")
    kept = dashboard.source_dashboard(spark.read.parquet(f"{base}/source_sketches"))
    exact = calls.join(kept, "source_id").groupBy("source_id").agg(
        F.count_distinct("url").alias("n"), F.avg((F.col("duration_sec") <= F.col("p50_sec")).cast("double")).alias("r50"),
        F.avg((F.col("duration_sec") <= F.col("p95_sec")).cast("double")).alias("r95"))
    return kept.join(exact, "source_id").select(
        "source_id", "runs", "calls", "failures", "slowest_sec",
        (F.abs(F.col("distinct_urls") / F.col("n") - 1) <= 0.05).alias("urls_near"),
        F.col("r50").between(0.48, 0.52).alias("p50_near"), F.col("r95").between(0.93, 0.97).alias("p95_near"))


# semantic dedupe ---------------------------------------------------------------
@query
def semantic_classes(spark, d):
    return semantic.semantic_classes(fx.article_vectors(spark, d))


# flagship --------------------------------------------------------------------------
TOP_K = 3


@query
def flagship(spark, d):
    """New articles ranked for editors: the top 3 per source by overall
    score (then relevance, then id), after dedupe and enrichment."""
    from pyspark.sql import Window
    # valid_only keeps the filter above the decode (see there)
    e = _enriched(spark, d).withColumn("_unscored", F.when(F.col("overall_score").isNull(), F.lit("x")))
    e = en.valid_only(e, "_unscored")
    w = Window.partitionBy("source_name").orderBy(F.desc("overall_score"),
                                                  F.desc("relevance_score"), "doc_id")
    return (e.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP_K)
            .select("source_name", "rank", "doc_id", "article_url", "title_en", "tag",
                    "overall_score", "relevance_score"))




@query
def flagship_links(spark, d):
    """SURVEY §7.1 slice: discovered links (cap, URL filter, fallback) ->
    URL hash -> not yet stored -> score answers (keyed by the hash) ->
    the top 3 new, on-pattern links per source by overall score."""
    from pyspark.sql import Window
    new = dedupe.dedupe_new(dedupe.hash_urls(_kept_links(spark, d), "url"), fx.store(spark, d))
    scores = en.valid_only(en.decode_answers(fx.link_answers(spark, d), "hash_code", ("score",)), "sc_err")
    j = new.join(scores, "hash_code")
    w = Window.partitionBy("source_id").orderBy(F.desc("sc_overall_score"),
                                                F.desc("sc_relevance_score"), "pos")
    return (j.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOP_K)
            .select("source_id", "rank", "pos", "url", "hash_code",
                    F.col("sc_overall_score").alias("overall_score"),
                    F.col("sc_relevance_score").alias("relevance_score"),
                    F.col("sc_quality_score").alias("quality_score")))


# runs and syncs on a store folder ---------------------------------------------------
def _work_dir(spark, name):
    import uuid
    from .session import shared_path
    return shared_path(spark, "quire", "queries", f"{name}-{uuid.uuid4().hex[:12]}")


def _seed_facts(spark, d, store_dir):
    """All documents as stored articles."""
    from .plans import layout
    facts = fx.review_store(spark, d).withColumns({
        c: F.lit(None).cast("int" if c in ("read_minutes", "relevance_score", "quality_score",
                                           "overall_score", "needs_revision") else "string")
        for c in st.ARTICLE_COLUMNS if c not in ("unique_id", "hash_code", "status")})
    facts = facts.withColumns({"updated_at": F.lit(CFG.run_ts), "created_at": F.lit(CFG.run_ts),
                               "article_url": F.lit(""), "run_id": F.lit("seed")})
    layout.write_partition(st.store_columns(facts), f"{store_dir}/articles")


@query
def ingest_two_runs(spark, d):
    """Two runs with different links into one store: both are stored, and the
    second leaves out what the first stored."""
    from .plans.ingest import IngestInputs, run_ingest
    base = _work_dir(spark, "ingest2")
    for half, ts in ((0, "2026-01-01T00:00:00"), (1, "2026-01-02T00:00:00")):
        inp = IngestInputs(sources=fx.sources(spark, d), links=fx.links(spark, d).where(F.col("pos") % 2 == half),
                           bodies=load(spark, d, "pages", "url", "html"), responses=fx.link_answers(spark, d))
        run_ingest(spark, inp, f"{base}/store", f"{base}/out{half}", CurationConfig(run_ts=ts))
    return spark.read.parquet(f"{base}/store/articles").select("hash_code", "run_id", "overall_score")


@query
def run_counters(spark, d):
    """What two runs and a sync-back count, as their writes observed it."""
    from .plans.ingest import IngestInputs, run_ingest
    from .plans.syncback import run_syncback
    base = _work_dir(spark, "counters")
    rows = []
    for half, ts in ((0, "2026-01-01T00:00:00"), (1, "2026-01-02T00:00:00")):
        inp = IngestInputs(sources=fx.sources(spark, d), links=fx.links(spark, d).where(F.col("pos") % 2 == half),
                           bodies=load(spark, d, "pages", "url", "html"), responses=fx.link_answers(spark, d))
        got = run_ingest(spark, inp, f"{base}/store", f"{base}/out{half}", CurationConfig(run_ts=ts))
        rows += [(f"run{half}", k, got[k]) for k in ("total", "skipped", "new")]
        rows.append((f"run{half}", "scraped_rows", got["scraped_shape"][0]))
    _seed_facts(spark, d, f"{base}/reviewed")
    got = run_syncback(spark, fx.mirror_pull(spark, d), f"{base}/reviewed", SYNC_TS, "sync")
    rows += [("sync", k, v) for k, v in got.items()]
    return spark.createDataFrame(rows, "step string, counter string, value bigint")


SYNC_TS_2 = "2026-01-03T00:00:00"


@query
def status_two_syncs(spark, d):
    """READY on one day, then PUBLISHED for two documents in three on the next,
    at the same or a lower position: the later sync wins."""
    from .plans import layout
    from .plans.syncback import run_syncback
    base = _work_dir(spark, "sync2")
    _seed_facts(spark, d, f"{base}/store")
    i = F.col("doc_id")
    run_syncback(spark, fx.plain_pull(spark, d, i * 2, F.lit("READY")), f"{base}/store", SYNC_TS, "one")
    second = F.when(i % 3 == 0, F.lit("READY")).otherwise(F.lit("PUBLISHED"))
    run_syncback(spark, fx.plain_pull(spark, d, F.when(i % 2 == 0, i * 2).otherwise(i), second),
                 f"{base}/store", SYNC_TS_2, "another")
    return layout.current_articles(spark, f"{base}/store").select("unique_id", "status", "updated_at")


@query
def ready_feed(spark, d):
    """Two consumers read what became READY, one after each of two syncs and
    once more, the other after both: each transition once a consumer."""
    from .plans import feed
    from .plans.syncback import run_syncback
    store = f"{_work_dir(spark, 'feed')}/store"
    _seed_facts(spark, d, store)
    i, out = F.col("doc_id"), []

    def read(consumer, reading):
        out.append(feed.read_feed(spark, store, consumer, reading).select(
            F.lit(consumer).alias("consumer"), F.lit(reading).alias("reading"), "unique_id", "changed_at", "previous_status"))

    run_syncback(spark, fx.plain_pull(spark, d, i, F.when(i % 2 == 0, F.lit("READY")).otherwise(F.lit("DISCARD"))), store, SYNC_TS, "one")
    read("site", "1")
    run_syncback(spark, fx.plain_pull(spark, d, i, F.when(i % 3 == 0, F.lit("READY")).otherwise(F.lit("DISCARD"))), store, SYNC_TS_2, "two")
    read("site", "2")
    read("site", "1")  # asked for again: the same rows
    read("site", "3")
    read("mail", "1")
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows


@query
def archive_move(spark, d):
    """What readers see of a store before, during and after published and
    discarded articles move to the archive: every article once."""
    from .plans import archive, layout
    from .plans.syncback import run_syncback
    store = f"{_work_dir(spark, 'archive')}/store"
    _seed_facts(spark, d, store)
    run_syncback(spark, fx.mirror_pull(spark, d), store, SYNC_TS, "one")
    seen = []

    def look(phase):
        now = layout.current_articles(spark, store).groupBy("status").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("unique_id").alias("n_ids"))
        seen.extend((phase, r.status, r.n, r.n_ids) for r in now.collect())  # a row a status

    look("before")
    archive.copy(spark, store, "2026Q1", F.col("status").isin("PUBLISHED", "DISCARD"))
    look("copied")
    archive.commit(spark, store, "2026Q1")
    look("committed")
    archive.clean(spark, store, "2026Q1")
    look("cleaned")
    left = spark.read.parquet(f"{store}/articles").count()
    seen.append(("live", None, left, left))
    return spark.createDataFrame(seen, "phase string, status string, n bigint, n_ids bigint")


# streaming -----------------------------------------------------------------------
DOCS_PER_FILE = 500


def _as_files(df, doc_id, path):
    """Rows as files of bounded size; a document's rows share one."""
    df.withColumn("part", F.floor(doc_id / DOCS_PER_FILE)).write.partitionBy("part").parquet(path)


@query
def stream_ingest(spark, d):
    """Scraped rows arrive as files in micro-batches; the store they build holds
    the same hashes as one batch run."""
    from .streaming.incremental import ingest_stream
    from .plans import layout
    base = _work_dir(spark, "ingest")
    # the store already holds the previously processed articles
    seed = fx.store(spark, d).select("hash_code", "unique_id", F.lit("seed").alias("run_id"))
    layout.write_hashes(seed, f"{base}/store")
    _as_files(fx.scraped(spark, d), F.col("doc_id"), f"{base}/in")
    # the answers are a table, as a model's are: not made again for each batch
    answers = fx.responses(spark, d)
    answers.write.parquet(f"{base}/answers")
    answers = spark.read.schema(answers.schema).parquet(f"{base}/answers")
    ingest_stream(spark, f"{base}/in/part=*", answers, f"{base}/store", f"{base}/ckpt", CFG, files_per_batch=4)
    stored = spark.read.parquet(f"{base}/store/articles").select(
        "hash_code", "status", F.lit(None).cast("string").alias("reject_reason"))
    rejects = layout.read_or_empty(spark, f"{base}/store/rejects", layout.REJECTS_SCHEMA)
    return stored.unionByName(rejects.select(
        "hash_code", F.lit(None).cast("string").alias("status"), "reject_reason"))


@query
def stream_syncback(spark, d):
    """Mirror pulls arrive as files (a record's rows share a file); the store's
    statuses after the stream equal one batch sync-back."""
    from .plans import layout
    from .streaming.incremental import syncback_stream
    base = _work_dir(spark, "sync")
    _seed_facts(spark, d, f"{base}/store")
    _as_files(fx.mirror_pull(spark, d), F.floor(F.col("pos") / 2), f"{base}/in")
    syncback_stream(spark, f"{base}/in/part=*", f"{base}/store", f"{base}/ckpt", SYNC_TS, files_per_batch=4)
    return layout.current_articles(spark, f"{base}/store").select("unique_id", "status")


@query
def stream_syncback_restart(spark, d):
    """Two streams with checkpoints of their own, one after the other: the
    second keeps what the first has changed."""
    from .plans import layout
    from .streaming.incremental import syncback_stream
    base = _work_dir(spark, "resync")
    _seed_facts(spark, d, f"{base}/store")
    i = F.col("doc_id")
    for n, (status, ts) in enumerate(((F.lit("READY"), SYNC_TS),
                                      (F.when(i % 2 == 0, F.lit("DISCARD")), SYNC_TS_2))):
        _as_files(fx.plain_pull(spark, d, i, status), F.col("pos"), f"{base}/in{n}")
        syncback_stream(spark, f"{base}/in{n}/part=*", f"{base}/store", f"{base}/ckpt{n}", ts, files_per_batch=100)
    return layout.current_articles(spark, f"{base}/store").select("unique_id", "status", "updated_at")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
