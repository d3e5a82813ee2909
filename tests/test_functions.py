"""Layer 1: column expressions against plain-Python expectations."""

import hashlib

import pytest
from pyspark.sql import functions as F

from quire.functions import text as tx
from quire.functions.richtext import rich_text, status_text
from quire.functions.timeparse import to_epoch_ms
from quire.functions.retry import retry_action, retry_wait_sec
from quire.functions.html import html_to_text
from quire.functions.usage import add_usage_columns
from quire.operators.discover import is_article_url


def rows(spark, values, schema="s string"):
    return spark.createDataFrame([(v,) for v in values], schema)


def test_whitespace_set_is_pythons():
    allws = sorted(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert sorted(tx.PY_WHITESPACE) == allws and len(allws) == 29


# url -> the text whose SHA-256 identifies it
HASHED = {
    None: "", "": "", "  ": "", "/": "", "https://a.org/x": "https://a.org/x",
    "https://a.org/x/": "https://a.org/x", "https://a.org/x///": "https://a.org/x",
    " https://a.org/x ": "https://a.org/x", "https://a.org/x/ ": "https://a.org/x",
    "https://a.org/x /": "https://a.org/x ", "https://a.org/\u00fc/": "https://a.org/\u00fc",
}


def test_url_hash_table(spark):
    got = rows(spark, list(HASHED)).select("s", tx.url_hash("s").alias("h")).collect()
    for r in got:
        assert r.h == hashlib.sha256(HASHED[r.s].encode()).hexdigest(), repr(r.s)


def test_url_hash_drops_every_white_space_around(spark):
    want = hashlib.sha256(b"https://a.org/p").hexdigest()
    around = [c + "https://a.org/p/" + c for c in tx.PY_WHITESPACE]
    assert {r.h for r in rows(spark, around).select(tx.url_hash("s").alias("h")).collect()} == {want}


# (text, cap) -> cut text
CUT = [
    (None, 10, ""), ("", 10, ""), ("abcdefghij", 10, "abcdefghij"), ("abcdefghijk", 10, "abcdefg..."),
    ("abcdef ghijk", 10, "abcdef..."), ("abc \t\u00a0\u3000ghijk", 10, "abc..."), ("       xxxxx", 10, "..."),
    ("\U0001f600" * 11, 10, "\U0001f600" * 7 + "..."),
]


def test_truncate_table(spark):
    for text, cap, want in CUT:
        got = rows(spark, [text]).select(tx.truncate_text("s", cap).alias("t")).first().t
        assert got == want, (text, cap)
    long = rows(spark, ["a" * 1900, "a" * 1901]).select(tx.truncate_text("s").alias("t")).collect()
    assert [r.t for r in long] == ["a" * 1900, "a" * 1897 + "..."]


def test_overall_score_is_half_to_even(spark):
    pairs = [(r, q) for r in range(11) for q in range(11)]
    df = spark.createDataFrame(pairs, "r int, q int")
    got = df.select("r", "q", F.bround((F.col("r") + F.col("q")) / 2, 0).cast("int").alias("o"))
    for row in got.collect():
        assert row.o == round((row.r + row.q) / 2)


EPOCH_CASES = {
    "2026-05-03": 1777766400000, "2026-05-03T10:11:12": 1777803072000,
    "2026-05-03 10:11:12": 1777803072000, "2026-05-03T10:11": 1777803060000,
    "2026-05-03T10:11:12Z": 1777803072000, "2026-05-03T10:11:12.345Z": 1777803072345,
    "2026-05-03T10:11:12+08:00": 1777774272000, "2026-05-03T1:2:3": 1777770123000,
    "2026-5-3": 1777766400000, "2026-05-03  10:11:12": 1777803072000,
    "20260503": 1777766400000, "2026-05-03T10:11:12,5": 1777803072500,
    "2026": None, "2026-05": None, "May 3, 2026": None, "2026-02-30": None,
    "2026-05-03T10:11:60": None, "": None, None: None, " 2026-05-03 ": 1777766400000,
}


def test_epoch_ms_table(spark):
    got = dict(rows(spark, list(EPOCH_CASES)).select("s", to_epoch_ms("s").alias("ms")).collect())
    assert got == EPOCH_CASES


def test_epoch_ms_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        got = dict(rows(spark, list(EPOCH_CASES)).select("s", to_epoch_ms("s").alias("ms"))
                   .collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == EPOCH_CASES


def _decode(spark, node, payloads):
    from quire.operators.enrich import decode_node
    df = spark.createDataFrame([(i, p, None) for i, p in enumerate(payloads)],
                               "doc_id long, response string, error string")
    return decode_node(df, node).orderBy("doc_id").collect()


@pytest.mark.parametrize("lit,ok,value", [
    ("7", True, 7), ('"7"', True, 7), ('" 7 "', True, 7), ("7.0", True, 7), ('"7.0"', True, 7),
    ("true", True, 1), ("7.5", False, None), ('"7.50"', False, None), ("null", False, None),
    (None, False, None), ("11", False, None), ("-1", False, None), ('"x"', False, None),
])
def test_lax_int_score(spark, lit, ok, value):
    body = '"quality_score": 3, "reason": "r"'
    payload = "{" + (f'"relevance_score": {lit}, ' if lit is not None else "") + body + "}"
    r = _decode(spark, "score", [payload])[0]
    assert (r.sc_err is None) == ok
    assert r.sc_relevance_score == value
    if lit is None:
        assert r.sc_err == "missing:relevance_score"


@pytest.mark.parametrize("lit,ok,value", [
    ("true", True, True), ('"true"', True, True), ('"yes"', True, True), ('"0"', True, False),
    ("1", True, True), ("0", True, False), ("2", False, None), ('"x"', False, None),
    ("null", False, None),
])
def test_lax_bool(spark, lit, ok, value):
    fields = ", ".join(f'"{f}": ""' for f in ("title_zh", "title_en", "excerpt_zh", "excerpt_en",
                                              "author", "country", "published_at", "notes",
                                              "review_notes"))
    payload = "{" + fields + f', "read_minutes": 3, "needs_revision": {lit}' + "}"
    r = _decode(spark, "review", [payload])[0]
    assert (r.rv_err is None) == ok
    assert r.rv_needs_revision == value


def test_decode_errors(spark):
    got = _decode(spark, "generate_tag", ['{"tag": "VISA", "tag_reason": "x", "extra": 1}',
                                          '{"tag": "OTHER", "tag_reason": "x"}',
                                          '{"tag": "VISA", "tag_reason": 5}',
                                          '{"tag": "VISA"', None])
    assert [r.tg_err for r in got] == [None, "enum:tag", "type:tag_reason", "invalid_json",
                                       "missing_response"]
    assert got[0].tg_tag == "VISA" and got[1].tg_tag is None


# cell -> its text
CELLS = {
    '"plain"': "plain", '[{"type":"text","text":"a"}, 3, {"type":"m"}, {"text":"b"}]': "ab", '{"text":"d"}': "d",
    "null": "", None: "", "5": "5", '{"x":1}': "", "not json": "not json", "[]": "", '[{"text":null}]': "", '""': "",
}


def test_rich_text_shapes(spark):
    got = rows(spark, list(CELLS)).select("s", rich_text("s").alias("t")).collect()
    assert {r.s: r.t for r in got} == CELLS


def test_status_text(spark):
    cells = ['" READY "', '{"text":" READY "}', '"READY"', None, '""']
    got = [r.t for r in rows(spark, cells).select(status_text("s").alias("t")).collect()]
    assert got == ["READY", " READY ", "READY", "", ""]


def test_retry_plan_expressions(spark):
    df = spark.createDataFrame([
        ("Rate Limit Exceeded: please retry after 7s, resets", 0),
        ("RATE LIMIT hit", 1), ("rate limit", 3), ("timeout", 0)], "e string, a int")
    got = df.select(retry_action(F.col("e"), F.col("a")).alias("act"),
                    retry_wait_sec(F.col("e")).alias("w")).collect()
    assert [r.act for r in got] == ["retry", "retry", "fail", "fail"]
    assert got[0].w == 9.0 and got[1].w == 62.0


def test_usage_precedence(spark):
    recs = ['{"token_usage": {"prompt_tokens": 5, "completion_tokens": 2, "total_tokens": 9}}',
            '{"token_usage": {"input_tokens": 5, "output_tokens": 2}}',
            '{"token_usage": {"prompt_tokens": 0}, "usage": {"input_tokens": 4, "output_tokens": 1}}',
            '{"generations": [{"usage_metadata": {"input_tokens": 2, "output_tokens": 3}},'
            ' {"usage_metadata": {"input_tokens": 1, "output_tokens": 1, "total_tokens": 5}}]}',
            '{"generations": [[{"message": {"usage_metadata": {"input_tokens": 4, "output_tokens": 1}}}],'
            ' [{"usage_metadata": {"input_tokens": 1, "output_tokens": 1}}]]}', '{}', None]
    df = add_usage_columns(rows(spark, recs, "usage string"), "usage")
    got = [(r.input_tokens, r.output_tokens, r.total_tokens) for r in df.collect()]
    assert got == [(5, 2, 9), (5, 2, 7), (4, 1, 5), (3, 4, 5), (5, 2, 7), (0, 0, 0), (0, 0, 0)]


# url -> (kept with the source's pattern, kept without one)
KEPT = {
    "https://a.org/news": (False, False), "https://a.org/news///": (False, False), "https://a.org/news/1": (True, True),
    "https://a.org/news/1.PDF": (False, False), "https://a.org/news/1.pdf#p": (False, True),
    "https://a.org/news/2.jpg?x=1": (False, False), "https://a.org/news/3.html": (True, True),
    "https://a.org/news/3#top": (False, True), "": (False, False), None: (False, False),
    "https://a.org/news/4/": (True, True), "https://b.org/news/5": (False, True), "https://a.org/a.mp4x": (False, True),
}


def test_url_filter_predicate(spark):
    src = "https://a.org/news"
    pat = r"^https?://a[.]org/news/[0-9]+(?:/|$|[.]html$)"
    df = spark.createDataFrame([(u, src, p) for u in KEPT for p in (pat, None, "")],
                               "url string, src string, pat string")
    got = df.select("url", "pat", is_article_url(F.col("url"), F.col("src"), F.col("pat"))
                    .alias("k")).collect()
    for r in got:
        assert bool(r.k) == KEPT[r.url][0 if r.pat else 1], (r.url, r.pat)


def test_url_filter_applied_twice_changes_nothing(spark):
    df = spark.createDataFrame([(u, "https://a.org/news", "/news/") for u in KEPT], "url string, src string, pat string")
    keep = is_article_url(F.col("url"), F.col("src"), F.col("pat"))
    assert sorted(df.where(keep).collect()) == sorted(df.where(keep).where(keep).collect())


def test_html_to_text(spark):
    html = ("<html><head><title>T</title><style>p{}</style></head><body><nav>menu</nav>"
            "<!-- c --><script>var t='</p>';</script><h1>Title</h1><p>a &amp; b<br>c</p></body>")
    t = rows(spark, [html]).select(html_to_text("s").alias("t")).first().t
    assert t == "Title\na & b\nc"
