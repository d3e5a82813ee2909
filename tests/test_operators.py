"""Layer 2: operator behaviour on small hand-made inputs (brute-force
expectations written out by hand)."""

from pyspark.sql import functions as F

from quire.config import CurationConfig
from quire.operators import dedupe, discover, enrich, metrics, mirror, schema_check, store
from quire.schemas import MIRROR_FIELDS

SRC = "source_id string, name string, url string, url_pattern string"
LNK = "source_id string, source_url string, mode string, pos long, url string"


def _links(spark, rows):
    return spark.createDataFrame(rows, LNK)


def test_fallback_used_only_when_nothing_kept(spark):
    src = spark.createDataFrame([("s1", "one", "https://a.org/n", None),
                                 ("s2", "two", "https://b.org/n", r"/n/[0-9]+$")], SRC)
    links = _links(spark, [
        ("s1", "https://a.org/n", "default", 1, "https://a.org/n/1"),
        ("s1", "https://a.org/n", "sitemap", 2, "https://a.org/n/2"),
        ("s2", "https://b.org/n", "default", 1, "https://b.org/n/"),      # landing page
        ("s2", "https://b.org/n", "default", 2, "https://b.org/n/x.pdf"),  # asset
        ("s2", "https://b.org/n", "sitemap", 3, "https://b.org/n/7"),
        ("s2", "https://b.org/n", "sitemap", 4, "https://b.org/n/8"),
    ])
    got = discover.discover_with_fallback(links, src, 5).select("source_id", "url").collect()
    assert sorted(tuple(r) for r in got) == [("s1", "https://a.org/n/1"), ("s2", "https://b.org/n/7"),
                                             ("s2", "https://b.org/n/8")]
    counts = {r.source_id: (r.used_fallback, r.discovered, r.kept)
              for r in discover.discover_counts(links, src, 5).collect()}
    assert counts == {"s1": (False, 1, 1), "s2": (True, 2, 2)}


def test_failed_discovery_status(spark):
    src = spark.createDataFrame([("s1", "one", "https://a.org/n", None)], SRC)
    links = _links(spark, [("s1", "https://a.org/n", "default", 1, "https://a.org/n/1")])
    status = spark.createDataFrame([("s1", "default", False)], "source_id string, mode string, ok boolean")
    assert discover.discover_with_fallback(links, src, 5, status=status).count() == 0


def test_limit_before_or_after_filter(spark):
    src = spark.createDataFrame([("s", "n", "https://a.org/n", None)], SRC)
    rows = [("s", "https://a.org/n", "default", i, f"https://a.org/n/{i}.pdf") for i in range(3)]
    rows += [("s", "https://a.org/n", "default", 10 + i, f"https://a.org/n/{i}") for i in range(3)]
    links = _links(spark, rows)
    assert discover.discover(links, src, 3, "discover").count() == 0
    assert discover.discover(links, src, 3, "kept").count() == 3
    c = discover.discover_counts(links, src, 2, "kept").first()
    assert (c.discovered, c.kept) == (6, 2)   # the cap on kept links hides none that were discovered


def test_duplicates_and_discarded_rows_block(spark):
    rows = spark.createDataFrame([(1, "https://x.org/a"), (2, " https://x.org/a/"),
                                  (3, "https://x.org/b"), (4, "https://x.org/c")],
                                 "doc_id long, article_url string")
    rows = dedupe.hash_urls(rows)
    st = dedupe.hash_urls(spark.createDataFrame([("https://x.org/c", "DISCARD")],
                                                "article_url string, status string"))
    new = dedupe.dedupe_new(rows, st)
    win, lose = dedupe.batch_unique(new, ("doc_id",))
    assert sorted(r.doc_id for r in win.collect()) == [1, 3]
    assert [(r.doc_id, r.reject_reason) for r in lose.collect()] == [(2, "duplicate_hash")]
    c = dedupe.dedupe_counts(rows, st).first()
    assert (c.total, c.skipped, c.new) == (4, 1, 3)


EX = ('{"title_zh": "t", "title_en": "T", "excerpt_zh": "e", "excerpt_en": "E", "author": "a",'
      ' "country": "c", "published_at": "2025-01-01", "read_minutes": 2, "notes": ""}')
SC = '{"relevance_score": 5, "quality_score": 6, "reason": "r"}'
TG = '{"tag": "VISA", "tag_reason": "x"}'
RV = EX[:-1] + ', "needs_revision": "yes", "review_notes": "n"}'


def _enrich(spark, responses, mode):
    arts = spark.createDataFrame([(1, "h1", "https://u/1", "s", "body", "2026-01-01T00:00:00"),
                                  (2, "h2", "https://u/2", "s", "body", "2026-01-01T00:00:00")],
                                 "doc_id long, hash_code string, article_url string, source_name string,"
                                 " raw_markdown string, scraped_at string")
    resp = spark.createDataFrame(responses, "doc_id long, node string, response string, error string")
    out = enrich.enrich(arts, resp, CurationConfig(run_ts="2026-01-01T00:00:00", on_missing_excerpt=mode))
    return {r.doc_id: r for r in out.collect()}


def test_enrich_collapse_and_accumulate(spark):
    resp = [(1, "extract", EX, None), (1, "score", SC, None), (1, "generate_tag", TG, None),
            (1, "review", RV, None),
            (2, "extract", None, "boom"), (2, "score", SC, None), (2, "generate_tag", TG, None),
            (2, "review", RV, None)]
    c = _enrich(spark, resp, "collapse")
    assert c[1].stage_errors == [] and c[1].overall_score == 6 and c[1].needs_revision is True
    assert c[1].tag == "VISA"
    assert [tuple(e) for e in c[2].stage_errors] == [("ainvoke", "'excerpt_en'")]
    assert c[2].relevance_score is None and c[2].title_en is None
    a = _enrich(spark, resp, "accumulate")
    assert [tuple(e) for e in a[2].stage_errors] == [("extract", "boom"),
                                                     ("generate_tag", "missing:excerpt_en")]
    assert a[2].relevance_score == 5 and a[2].title_en == "T" and a[2].tag is None


def test_missing_answers_fail_each_stage(spark):
    c = _enrich(spark, [(1, "extract", EX, None)], "accumulate")
    assert [e.node for e in c[1].stage_errors] == ["score", "generate_tag", "review"]
    assert {e.error for e in c[1].stage_errors} == {"missing_response"}


def _snapshot(spark, recs):
    names = [n for n, _ in MIRROR_FIELDS]
    rows = []
    for rid, pos, cells in recs:
        rows.append((rid, pos, *[cells.get(n) for n in names]))
    types = {1: "string", 3: "string", 15: "struct<link:string,text:string>", 5: "bigint",
             2: "double", 7: "boolean"}
    schema = "record_id string, record_pos long, " + ", ".join(
        f"{n} {types[t]}" for n, t in MIRROR_FIELDS)
    return spark.createDataFrame(rows, schema)


def test_upsert_keeps_omitted_cells(spark):
    snap = _snapshot(spark, [("r1", 1, {"unique_id": "u1", "author": "old", "title_zh": "old",
                                        "needs_revision": True, "notes": "keep"}),
                             ("r2", 2, {"unique_id": "u1", "author": "dup"}),
                             ("r3", 3, {"unique_id": "u9", "author": "other"})])
    inc = _snapshot(spark, [("x", 0, {"unique_id": "u1", "title_zh": "new", "author": None,
                                      "needs_revision": False, "country": "UK"}),
                            ("y", 0, {"unique_id": "u2", "title_zh": "fresh"}),
                            ("z", 0, {"unique_id": None, "title_zh": "no id"})]).drop(
        "record_id", "record_pos")
    out = {r.record_id: r for r in mirror.upsert(snap, inc).collect()}
    assert out["r1"].action == "updated" and out["r1"].author == "old" and out["r1"].notes == "keep"
    assert out["r1"].title_zh == "new" and out["r1"].needs_revision is False
    assert out["r1"].country == "UK"
    assert out["r2"].action == "unchanged" and out["r2"].author == "dup"
    assert out["r3"].action == "unchanged"
    assert out["new-u2"].action == "created"
    assert len(out) == 4


def test_status_pull_and_diff(spark):
    pull = spark.createDataFrame([
        (0, True, 1, '"a"', '"READY"'), (0, True, 2, '"a"', '"DISCARD"'),
        (0, True, 3, '"a"', '"REVIEWING"'),     # equals store: must not undo pos 2
        (0, True, 4, '"b"', '"ARCHIVED"'), (0, True, 5, '""', '"READY"'),
        (0, True, 6, '"zzz"', '"READY"'),       # unknown id
        (1, False, 7, '"c"', '"READY"'), (2, True, 8, '"c"', '"READY"')],
        "page long, page_ok boolean, pos long, unique_id_cell string, status_cell string")
    store_df = spark.createDataFrame([("a", "REVIEWING"), ("b", "READY"), ("c", "REVIEWING")],
                                     "unique_id string, status string")
    valid, bad = mirror.pull_statuses(pull)
    assert sorted((r.pos, r.reject_reason) for r in bad.collect()) == [(4, "invalid_status"),
                                                                      (5, "blank")]
    assert {r.pos for r in valid.collect()} == {1, 2, 3, 6}   # page 1 failed: pages >= 1 dropped
    ups = mirror.status_updates(mirror.status_diff_rows(valid, store_df)).collect()
    assert [(r.unique_id, r.old_status, r.new_status) for r in ups] == [("a", "REVIEWING", "DISCARD")]


def test_tag_clear_and_invalid(spark):
    facts = spark.createDataFrame([("a", "VISA", "t0"), ("b", "CITY", "t0"), ("c", "CITY", "t0")],
                                  "unique_id string, tag string, updated_at string")
    ch = spark.createDataFrame([("a", None, True, "t1", 1), ("b", "GOSSIP", False, "t1", 1),
                                ("c", "MARKET", False, "t1", 1), ("c", "REPORT", False, "t2", 2),
                                ("zz", "VISA", False, "t1", 1)],
                               "unique_id string, tag string, is_clear boolean, changed_at string, seq long")
    got = {r.unique_id: (r.tag, r.updated_at, r.changed) for r in store.apply_tag(facts, ch).collect()}
    assert got == {"a": (None, "t1", True), "b": ("CITY", "t0", False), "c": ("REPORT", "t2", True)}


def test_schema_diff(spark):
    rows = spark.createDataFrame([("x", None, "y")], "title_zh string, tag string, owner string")
    obs = schema_check.listed_fields(rows, {"title_zh": 1, "tag": 3, "owner": 1})
    exp = spark.createDataFrame([("title_zh", 2), ("tag", 3), ("stage_errors", 1)],
                                "name string, type_id int")
    got = sorted(tuple(r) for r in schema_check.schema_diff(exp, obs).collect())
    assert got == [("extra", "owner", None, "text", 1), ("mismatch", "title_zh", "number", "text", 1),
                   ("missing", "stage_errors", "text", None, 0)]  # the blank tag is there


def test_stage_metrics_counts_timed_calls_only(spark):
    att = spark.createDataFrame([
        ("extract", 1.0, '{"usage": {"input_tokens": 3, "output_tokens": 1}}'),
        ("extract", 2.0, None), ("extract", None, '{"usage": {"input_tokens": 1, "output_tokens": 1}}'),
        ("map", 0.5, None)], "stage string, duration_sec double, usage string")
    got = {r.stage: tuple(r)[1:] for r in metrics.stage_metrics(att).collect()}
    assert got == {"extract": (2, 3.0, 1.5, 4, 2, 6), "map": (1, 0.5, 0.5, 0, 0, 0)}


def test_store_rows_and_checks(spark):
    rec = spark.createDataFrame([("h1", "https://u", "VISA", True), ("", "https://v", None, None),
                                 ("h3", "https://w", "GOSSIP", False)],
                                "hash_code string, article_url string, tag string, needs_revision boolean")
    rec = rec.withColumn("stage_errors", F.array().cast("array<struct<node:string,error:string>>"))
    rows = store.to_store_rows(rec, CurationConfig(run_ts="2026-01-01T00:00:00"))
    ok, bad = store.check_rows(rows)
    assert [r.hash_code for r in ok.collect()] == ["h1"]
    assert sorted(r.reject_reason for r in bad.collect()) == ["bad_tag", "missing_hash"]
    r = ok.first()
    assert r.needs_revision == 1 and r.stage_errors == "[]" and len(r.unique_id) == 32


def test_hot_hash_third_of_rows(spark):
    """One URL holds a third of the batch: still one winner, and the winner
    is found by aggregation (no window over the hot hash)."""
    n = 3000
    rows = [(i, "https://x.org/hot/" if i % 3 == 0 else f"https://x.org/{i}") for i in range(n)]
    df = dedupe.hash_urls(spark.createDataFrame(rows, "doc_id long, article_url string")
                          .repartition(8))
    win, lose = dedupe.batch_unique(df, ("doc_id",))
    assert win.count() == n - n // 3 + 1 and lose.count() == n // 3 - 1
    assert win.where("article_url = 'https://x.org/hot/'").first().doc_id == 0
    plan = win._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "HashAggregate" in plan
    st = dedupe.hash_urls(spark.createDataFrame([("https://x.org/hot",)], "article_url string"))
    assert dedupe.dedupe_new(df, st).count() == n - n // 3


def test_one_winner_even_among_equal_rows(spark):
    rows = [(1, "https://x.org/a", "m")] * 3 + [(1, "https://x.org/a/", "n"), (2, "https://x.org/a", "m"), (3, "https://x.org/b", "m")]
    df = dedupe.hash_urls(spark.createDataFrame(rows, "doc_id long, article_url string, body string"))
    df = df.unionByName(df.limit(1).withColumns({"hash_code": F.lit(None).cast("string"), "doc_id": F.lit(9).cast("long")}))
    win, lose = dedupe.batch_unique(df, ("doc_id",))
    assert sorted((r.doc_id, r.article_url) for r in win.collect()) == [(1, "https://x.org/a"), (3, "https://x.org/b")]
    got = sorted((r.doc_id, r.article_url, r.reject_reason) for r in lose.collect())
    assert got == [(1, "https://x.org/a", "duplicate_hash")] * 2 + [(1, "https://x.org/a/", "duplicate_hash"), (2, "https://x.org/a", "duplicate_hash"),
                                                                    (9, "https://x.org/a", "missing_hash")]
    seen = dedupe.hash_urls(spark.createDataFrame([("https://x.org/b",)], "article_url string")).select("hash_code")
    win, lose = dedupe.batch_unique(df, ("doc_id",), seen)
    assert win.count() == 1 and lose.where("doc_id = 3").count() == 0


def test_one_body_per_url(spark):
    from quire.operators import fetch
    kept = spark.createDataFrame([("s", 1, "n", "u", "https://a/1"), ("s", 2, "n", "u", "https://a/2"), ("s", 3, "n", "u", "https://a/3")],
                                 "source_id string, pos long, source_name string, source_url string, url string")
    bodies = spark.createDataFrame([("https://a/1", "<p>cut", None), ("https://a/1", "<p>whole text</p>", None), ("https://a/1", None, None),
                                    ("https://a/2", "<p>page</p>", "# markdown <b> as it is"), ("https://z", "<p>", None)],
                                   "url string, html string, markdown string")
    got = {r.article_url: r.markdown for r in fetch.scrape_join(kept, bodies.unionByName(bodies)).collect()}
    assert got == {"https://a/1": "whole text", "https://a/2": "# markdown <b> as it is", "https://a/3": None}
    assert fetch.scrape_join(kept, bodies.drop("markdown")).count() == 3

    def fetcher(url):
        if url.endswith("2"):
            raise OSError("refused")
        return f"body of {url}"

    got = {r.url: (r.markdown, r.error) for r in fetch.fetch_bodies(kept, fetcher).collect()}
    assert got["https://a/1"] == ("body of https://a/1", None) and got["https://a/2"] == (None, "OSError: refused")


def test_model_failures_stay_with_their_rows(spark):
    import pandas as pd

    def model(pdf):
        if (pdf["doc_id"] % 3 == 0).any():
            raise RuntimeError("no answer")
        assert pdf["system"].str.len().min() > 40
        return pd.DataFrame({"doc_id": pdf["doc_id"], "node": pdf["node"], "response": SC, "error": None,
                             "usage": '{"usage": {"input_tokens": 2, "output_tokens": 1}}'})

    asked = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("score").alias("node"), F.lit("p").alias("prompt"))
    answers = enrich.infer(asked, model)
    got = {r.doc_id: r for r in answers.collect()}
    assert {i for i, r in got.items() if r.error} == {0, 3, 6, 9}
    assert got[3].error == "RuntimeError: no answer" and got[3].response is None and got[4].response == SC
    m = {r.stage: r for r in metrics.stage_metrics(enrich.model_attempts(answers)).collect()}
    assert m["score"]["count"] == 6 and m["score"].total_tokens == 18


def test_answers_given_twice_count_once(spark):
    resp = [(1, "score", None, "late"), (1, "score", SC, None), (1, "score", SC, None), (1, "score", SC.replace("5", "4"), None)]
    a = _enrich(spark, resp, "accumulate")
    assert len(a) == 2 and a[1].relevance_score == 5


def test_latest_change_is_by_time_then_sync_then_position(spark):
    facts = spark.createDataFrame([(x, "REVIEWING", "t0") for x in "abcd"], "unique_id string, status string, updated_at string")
    ch = spark.createDataFrame([("a", "READY", "t1", "s1", 50), ("a", "PUBLISHED", "t2", "s2", 10), ("b", "READY", "t1", "s1", 5),
                                ("b", "PUBLISHED", "t2", "s2", 5), ("c", "READY", "t1", "s1", 9), ("c", "DISCARD", "t1", "s2", 1),
                                ("d", "READY", "t1", "s1", 1), ("d", "DISCARD", "t1", "s1", 2)],
                               "unique_id string, new_status string, changed_at string, run_id string, seq long")
    got = {r.unique_id: r.status for r in store.apply_status(facts, ch).collect()}
    assert got == {"a": "PUBLISHED", "b": "PUBLISHED", "c": "DISCARD", "d": "DISCARD"}


def test_metrics_rollup_total_row(spark):
    att = spark.createDataFrame([("a", 1.0, None), ("a", 2.0, None), ("b", 0.5, None)],
                                "stage string, duration_sec double, usage string")
    got = {r.stage: (r["count"], r.total_time_sec) for r in metrics.stage_rollup(att).collect()}
    assert got == {"a": (2, 3.0), "b": (1, 0.5), None: (3, 3.5)}


def test_upsert_feed_equals_changed_rows_of_full_upsert(spark):
    snap = _snapshot(spark, [("r1", 1, {"unique_id": "u1", "author": "old", "notes": "keep"}),
                             ("r2", 2, {"unique_id": "u1", "author": "dup"}),
                             ("r3", 3, {"unique_id": "u9", "author": "other"})])
    inc = _snapshot(spark, [("x", 0, {"unique_id": "u1", "title_zh": "new", "country": "UK"}),
                            ("y", 0, {"unique_id": "u2", "title_zh": "fresh"})]).drop(
        "record_id", "record_pos")
    full = mirror.upsert(snap, inc).where("action <> 'unchanged'")
    feed = mirror.upsert_feed(snap, inc)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, feed.select(*full.columns).collect()))


def test_discover_counts_with_status(spark):
    src = spark.createDataFrame([("s1", "one", "https://a.org/n", None),
                                 ("s2", "two", "https://b.org/n", None),
                                 ("s3", "three", "https://c.org/n", None)], SRC)
    links = _links(spark, [
        ("s1", "https://a.org/n", "default", 1, "https://a.org/n"),      # landing page only
        ("s1", "https://a.org/n", "sitemap", 2, "https://a.org/n/2"),
        ("s2", "https://b.org/n", "default", 1, "https://b.org/n"),
        ("s2", "https://b.org/n", "sitemap", 2, "https://b.org/n/2"),
        ("s3", "https://c.org/n", "default", 1, "https://c.org/n/1")])
    status = spark.createDataFrame([("s1", "default", True), ("s1", "sitemap", True),
                                    ("s2", "default", True), ("s2", "sitemap", False),
                                    ("s3", "default", False)],
                                   "source_id string, mode string, ok boolean")
    got = {r.source_id: (r.used_fallback, r.discovered, r.kept)
           for r in discover.discover_counts(links, src, 5, status=status).collect()}
    assert got == {"s1": (True, 1, 1), "s2": (False, 1, 0)}
    kept = discover.discover_with_fallback(links, src, 5, status=status)
    assert sorted(r.url for r in kept.collect()) == ["https://a.org/n/2"]
