"""Markdown of pages, change feed, archival, dashboards and an initialised store."""

import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from quire import registry
from quire.functions.markdown import to_markdown
from quire.operators import dashboard, fetch
from quire.plans import archive, feed, layout
from quire.plans.syncback import run_syncback
from quire.sources import fixtures as fx
from quire.sources.tables import load


# Markdown --------------------------------------------------------------------------
@pytest.mark.parametrize("html, want", [
    (None, None), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<h1>A</h1><h3>B <em>c</em></h3><p>d", "# A\n\n### B *c*\n\nd"),
    ("<p>a<br>b</p><p> c \n d </p>", "a\nb\n\nc d"),
    ("<ul><li>a<ul><li>b</li><li>c</li></ul></li><li>d</li></ul>", "- a\n  - b\n  - c\n- d"),
    ("<ol><li>x<li>y</ol>z", "1. x\n2. y\n\nz"),
    ('<a href="/p?q=1&amp;r=2">to <b>here</b></a> <a>no link</a>', "[to **here**](/p?q=1&r=2) no link"),
    ('<img src="i.png" alt="pic"><img alt="none">', "![pic](i.png)"),
    ("<blockquote><p>q</p><blockquote>r</blockquote></blockquote>s", "> q\n\n> > r\n\ns"),
    ("<pre>  x &lt; y\n\n    z</pre>", "```\n  x < y\n\n    z\n```"),
    ("<table><tr><th>A<th>B</tr><tr><td>1</td><td>2</td></tr></table>", "A | B\n\n1 | 2"),
    ("<p><b>open <i>marks<p>closed", "**open *marks***\n\nclosed"),
    ("a<script>if (a < b) { '<p>' }</script><style>p{}</style><!-- c --><nav><a href='x'>y</a></nav>b<hr>c", "ab\n\n---\n\nc"),
    ("<li>alone</li><p>x &nbsp; y &#233;&euro;</p>", "- alone\n\nx \xa0 y é€"),
])
def test_markdown_of_blocks(html, want):
    assert to_markdown(html) == want


def plain_words(html):
    """Words of a page by an independent reading: marked parts cut out, tags as ends of words or not."""
    text = re.sub(r"(?s)<!--.*?-->", "", html)
    text = re.sub(r"(?is)<(head|script|style|nav)\b.*?</\1\s*>", "", text)
    text = re.sub(r"(?i)</?(b|i|em|strong|a|code)\b[^>]*>", "", text)
    return unescape(re.sub(r"<[^>]*>", " ", text)).split()


def test_markdown_keeps_the_words_of_all_pages(spark):
    pages = load(spark, SF001, "pages", "page_id", "html")
    rows = {r.page_id: r for r in registry.queries()["page_markdown"](spark, SF001).collect()}
    html = {r.page_id: r.html for r in pages.collect()}
    assert rows.keys() == html.keys()
    for r in fetch.bodies_as_markdown(pages).collect():
        page = html[r.page_id]
        bare = re.sub(r"(?m)^(#{1,6} |- |\d+\. )", "", re.sub(r"\]\([^)]*\)|\*\*|\[", "", r.markdown))
        assert bare.split() == [w for w in (x.replace("[", "").replace("**", "") for x in plain_words(page)) if w], r.page_id
        body = re.sub(r"(?is)<(head|script|style|nav)\b.*?</\1\s*>", "", page)
        assert rows[r.page_id].n_headings == len(re.findall(r"(?i)<h[1-6]\b", body))
        assert "<p>" not in r.markdown and "var t" not in r.markdown


def test_markdown_bodies_join_the_links(spark):
    kept = spark.createDataFrame([("s", 1, "n", "u", "https://a/1")], "source_id string, pos long, source_name string, source_url string, url string")
    bodies = fetch.bodies_as_markdown(spark.createDataFrame([("https://a/1", "<h2>T</h2>x", "c"), ("https://b", None, "d")],
                                                            "url string, html string, other string"))
    assert bodies.columns == ["url", "markdown", "other"]
    assert [r.markdown for r in fetch.scrape_join(kept, bodies).collect()] == ["## T\n\nx"]


# store, feed, archive ----------------------------------------------------------------
def _store(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    registry._seed_facts(spark, SF001, store)
    return store


def _sync(spark, store, status, name, ts):
    run_syncback(spark, fx.plain_pull(spark, SF001, F.col("doc_id"), status), store, ts, name)


def test_an_initialised_store_has_all_tables(spark, tmp_dir):
    store = f"{tmp_dir}/store"
    layout.init_store(spark, store)
    for name, schema in layout.TABLES.items():
        df = spark.read.parquet(f"{store}/{name}")  # no schema given: the files have it
        assert df.count() == 0 and set(df.columns) == {x.split()[0] for x in schema().split(", ")}
    registry._seed_facts(spark, SF001, store)
    layout.init_store(spark, store)  # again: nothing is lost
    n = layout.current_articles(spark, store).count()
    assert n > 0
    _sync(spark, store, F.lit("READY"), "one", "2026-01-02T00:00:00")
    assert layout.current_articles(spark, store).where("status = 'READY'").count() == n


def test_each_transition_is_read_once(spark, tmp_dir):
    store = _store(spark, tmp_dir)
    read = lambda c, n: {(r.unique_id, r.sync, r.previous_status) for r in feed.read_feed(spark, store, c, n).collect()}
    assert read("site", "0") == set()
    first = {r.unique_id: r.status for r in layout.current_articles(spark, store).collect()}
    _sync(spark, store, F.lit("READY"), "one", "2026-01-02T00:00:00")
    got = read("site", "1")
    assert got == {(u, "one", s) for u, s in first.items() if s != "READY"}
    _sync(spark, store, F.lit("DISCARD"), "two", "2026-01-03T00:00:00")
    assert read("site", "2") == set()
    _sync(spark, store, F.lit("READY"), "three", "2026-01-04T00:00:00")
    assert read("site", "3") == {(u, "three", "DISCARD") for u in first}
    assert read("site", "4") == set() and read("site", "1") == got  # a reading can be repeated
    assert read("mail", "1") == got | {(u, "three", "DISCARD") for u in first}


def test_readers_see_each_article_once_while_it_moves(spark, tmp_dir):
    store = _store(spark, tmp_dir)
    _sync(spark, store, F.when(F.col("doc_id") % 3 == 0, F.lit("PUBLISHED")).otherwise(F.lit("READY")), "one", "2026-01-02T00:00:00")
    seen = lambda: sorted((r.unique_id, r.status) for r in layout.current_articles(spark, store).collect())
    before, due = seen(), F.col("status") == "PUBLISHED"
    archive.copy(spark, store, "m1", due)
    assert seen() == before
    archive.copy(spark, store, "m1", due)  # a first attempt that ended here
    archive.commit(spark, store, "m1")
    assert seen() == before
    archive.clean(spark, store, "m1")
    assert seen() == before
    left = spark.read.parquet(f"{store}/articles")
    assert left.count() == sum(s != "PUBLISHED" for _, s in before) < len(before)
    archive.archive_articles(spark, store, "m1", due)  # again: nothing more
    assert seen() == before
    _sync(spark, store, F.lit("DISCARD"), "two", "2026-01-05T00:00:00")  # archived articles take changes too
    assert {s for _, s in seen()} == {"DISCARD"}
    archive.archive_articles(spark, store, "m2", F.col("status") == "DISCARD")  # all that a run holds
    assert [u for u, _ in seen()] == [u for u, _ in before]


def test_dashboards_of_some_runs_and_empty_calls(spark):
    calls = spark.createDataFrame([("r1", "a", "u1", True, 1.0), ("r1", "a", "u1", False, 3.0), ("r2", "a", "u2", None, None),
                                   ("r2", "b", None, True, None)], "run_id string, source_id string, url string, ok boolean, duration_sec double")
    kept = dashboard.source_sketches(calls)
    got = {r.source_id: r for r in dashboard.source_dashboard(kept).collect()}
    a, b = got["a"], got["b"]
    assert (a.runs, a.calls, a.failures, a.distinct_urls, a.slowest_sec) == (2, 3, 2, 2, 3.0) and a.p95_sec == 3.0
    assert (b.calls, b.failures, b.distinct_urls, b.p50_sec, b.slowest_sec) == (1, 0, 0, None, None)
    assert dashboard.source_dashboard(kept.where("run_id = 'r1'")).first().distinct_urls == 1
    assert dashboard.source_dashboard(dashboard.source_sketches(calls.limit(0))).count() == 0


def test_readers_use_the_snapshot_published_last(spark, tmp_dir):
    mirror = f"{tmp_dir}/mirror"
    assert layout.current_snapshot(spark, mirror) is None
    for version, ts in (("b", "2026-01-01T00:00:00"), ("a", "2026-01-02T00:00:00"), ("c", None)):
        spark.createDataFrame([(version,)], "v string").write.parquet(f"{mirror}/version={version}")
        if ts:
            layout.publish(spark, mirror, version, ts)
    assert layout.current_snapshot(spark, mirror).first().v == "a"  # c was never published
    layout.publish(spark, mirror, "b", "2026-01-03T00:00:00")
    assert layout.current_snapshot(spark, mirror).first().v == "b"


def test_records_without_an_id_are_kept_apart(spark):
    from quire.operators import mirror
    inc = spark.createDataFrame([("u1", "h1"), ("", "h2"), (None, "h3")], "unique_id string, hash_code string")
    pushed, rejected = mirror.push_checks(inc)
    assert [r.hash_code for r in pushed.collect()] == ["h1"]
    assert {(r.hash_code, r.reject_reason) for r in rejected.collect()} == {("h2", "missing_unique_id"), ("h3", "missing_unique_id")}


def test_pages_that_cannot_be_read_end_the_pull(spark, tmp_dir):
    import json
    import os

    from quire.operators import mirror
    from quire.sources.pages import read_mirror_pages
    item = lambda u, s, **more: {"fields": {"unique_id": u, "status": s}, **more}
    bodies = {0: json.dumps({"code": 0, "items": [item([{"text": "a"}], "READY"), item("b", {"text": "DISCARD"}), {"fields": {}}]}),
              1: json.dumps({"items": []}), 2: json.dumps({"items": [item(7, "READY", pos=5)]}, indent=1)}
    for broken in ('{"items":[{"fie', json.dumps({"code": 1254, "items": [item("x", "READY")]}), json.dumps({"msg": "none"}), ""):
        path = f"{tmp_dir}/{abs(hash(broken))}"
        for page, body in {**bodies, 3: broken, 4: json.dumps({"items": [item("late", "READY")]})}.items():
            os.makedirs(f"{path}/page={page}")
            with open(f"{path}/page={page}/body.json", "w") as f:
                f.write(body)
        pull = read_mirror_pages(spark, path)
        assert {r.page for r in pull.where("NOT page_ok").collect()} == {3}
        valid, bad = mirror.pull_statuses(pull)
        assert sorted((r.pos, r.unique_id, r.status) for r in valid.collect()) == [(0, "a", "READY"), (1, "b", "DISCARD"), (5, "7", "READY")]
        assert [r.reject_reason for r in bad.collect()] == ["blank"]
