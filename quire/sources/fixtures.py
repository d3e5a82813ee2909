"""Input tables of the curation jobs, derived from the driver's test data.

The original tool gets these from remote services (a crawler, a model, a
review table). Here each one is a deterministic derivation of a given table
(pages, documents, labels, events), so its size grows with the data and the
same rows can be rebuilt in any SQL engine. Layout is described in
FIXTURES.md (F1-F9).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import url_hash
from ..schemas import MIRROR_FIELDS
from .tables import load

lit = F.lit

# Status chosen by id residue, and the tag answer list of the
# stand-in model (the last one is outside the tag domain on purpose).
STORE_STATUS_BY_MOD5 = ("READY", "PUBLISHED", "DISCARD", "REVIEWING", "REVIEWING")
MIRROR_STATUS_BY_MOD7 = ("READY", "PUBLISHED", "DISCARD", "REVIEWING", "REVIEWING",
                         "REVIEWING", "REVIEWING")
MODEL_TAGS = ("MARKET", "MENTOR", "REPORT", "VISA", "CITY", "OTHER")

HOST_RE = r"^https?://([^/?#]+)"
SEC_RE = r"^https?://[^/?#]+/([a-z]+)"


def _pick(key: Column, values) -> Column:
    return F.element_at(F.array(*[lit(v) for v in values]), (key + 1).cast("int"))


def _host_sec(url: Column):
    return F.regexp_extract(url, HOST_RE, 1), F.regexp_extract(url, SEC_RE, 1)


# F1 -------------------------------------------------------------------------
def sources(spark: SparkSession, d: str) -> DataFrame:
    host, sec = _host_sec(F.col("url"))
    hs = load(spark, d, "pages", "url").select(host.alias("host"), sec.alias("sec")).distinct()
    src = F.concat(lit("https://"), F.col("host"), lit("/"), F.col("sec"))
    pattern = F.when(F.length("host") % 4 != 0, F.concat(
        lit("^https?://"), F.replace(F.col("host"), lit("."), lit("[.]")), lit("/"),
        F.col("sec"), lit("/[0-9]+(?:/|$|[.]html$)")))
    return hs.select(src.alias("source_id"), F.col("host").alias("name"), src.alias("url"),
                     pattern.alias("url_pattern"))


# F2 -------------------------------------------------------------------------
def links(spark: SparkSession, d: str) -> DataFrame:
    p = load(spark, d, "pages", "page_id", "url")
    host, sec = _host_sec(F.col("url"))
    src = F.concat(lit("https://"), host, lit("/"), sec)
    pid = F.col("page_id")
    url = (F.when(pid % 23 == 0, lit(""))
           .when(pid % 19 == 0, F.concat(F.col("url"), lit("/photo.JPG?x=1")))
           .when(pid % 17 == 0, F.concat(src, lit("/")))
           .otherwise(F.col("url")))
    return p.select(src.alias("source_id"), src.alias("source_url"),
                    F.when(pid % 5 == 0, lit("sitemap")).otherwise(lit("default")).alias("mode"),
                    pid.alias("pos"), url.alias("url"))


# F3 -------------------------------------------------------------------------
def scraped(spark: SparkSession, d: str) -> DataFrame:
    doc = load(spark, d, "documents", "doc_id", "text", "lang", "source")
    i = F.col("doc_id")
    ident = F.when(i % 10 == 1, i - 1).otherwise(i).cast("string")
    article_url = F.concat(F.when(i % 7 == 0, lit("  ")).otherwise(lit("")),
                           lit("https://docs.example.org/"), ident,
                           F.when(i % 3 == 0, lit("/")).otherwise(lit("")))
    markdown = (F.when(i % 29 == 0, lit(None).cast("string"))
                .when(i % 31 == 0, lit("")).otherwise(F.col("text")))
    return doc.select(
        i.alias("doc_id"), F.col("source").alias("source_name"),
        F.concat(lit("https://"), F.col("source"), lit(".example.org/"), F.col("lang"))
        .alias("source_url"),
        article_url.alias("article_url"), markdown.alias("markdown"))


# F4 -------------------------------------------------------------------------
def store(spark: SparkSession, d: str) -> DataFrame:
    s = scraped(spark, d).where(F.col("doc_id") % 4 == 0)
    return s.select(F.col("doc_id").cast("string").alias("unique_id"),
                    url_hash("article_url").alias("hash_code"),
                    _pick(F.col("doc_id") % 5, STORE_STATUS_BY_MOD5).alias("status"))


# F5 -------------------------------------------------------------------------
def _published_at(i: Column) -> Column:
    ds = F.concat(lit("2025-"), F.lpad((1 + i % 12).cast("string"), 2, "0"), lit("-"),
                  F.lpad((1 + i % 28).cast("string"), 2, "0"))
    hm = F.concat(F.lpad((i % 24).cast("string"), 2, "0"), lit(":"),
                  F.lpad((i % 60).cast("string"), 2, "0"), lit(":05"))
    k = i % 6
    return (F.when(k == 0, ds).when(k == 1, F.concat(ds, lit("T"), hm))
            .when(k == 2, F.concat(ds, lit(" "), hm))
            .when(k == 3, F.concat(ds, lit("T"), hm, lit("Z")))
            .when(k == 4, lit("")).otherwise(lit("unknown")))


def _int_literal(i: Column, v: Column) -> Column:
    """The score as one of several JSON spellings; some are invalid on purpose."""
    s = v.cast("string")
    k = i % 8
    return (F.when(i % 53 == 0, F.concat(s, lit(".5")))
            .when(i % 59 == 0, F.concat(lit('"'), s, lit('.50"')))
            .when(i % 61 == 0, lit("null"))
            .when(k == 1, F.concat(lit('"'), s, lit('"')))
            .when(k == 2, F.concat(lit('" '), s, lit(' "')))
            .when(k == 3, F.concat(s, lit(".0")))
            .when(k == 4, F.concat(lit('"'), s, lit('.0"')))
            .otherwise(s))


def _bool_literal(i: Column, b: Column) -> Column:
    k = i % 4
    return (F.when(i % 47 == 0, lit("2"))
            .when(i % 43 == 0, lit('"x"'))
            .when(k == 0, F.when(b, lit("true")).otherwise(lit("false")))
            .when(k == 1, F.when(b, lit('"yes"')).otherwise(lit('"no"')))
            .when(k == 2, F.when(b, lit("1")).otherwise(lit("0")))
            .otherwise(F.when(b, lit('"true"')).otherwise(lit('"0"'))))


def responses(spark: SparkSession, d: str) -> DataFrame:
    """Stand-in model answers, one row per (doc_id, node)."""
    lab = load(spark, d, "labels", "doc_id", "quality")
    doc = load(spark, d, "documents", "doc_id", "text", "lang", "source", "n_chars")
    x = lab.join(doc, "doc_id")
    i = F.col("doc_id")
    first_line = F.regexp_extract(F.col("text"), r"^[^\n]*", 0)
    title_zh = F.concat(lit("["), F.col("lang"), lit("] "), first_line)
    common = [first_line.alias("excerpt_zh"), F.col("text").alias("excerpt_en"),
              F.col("source").alias("author"), F.upper("lang").alias("country"),
              _published_at(i).alias("published_at"),
              F.floor(F.col("n_chars") / 1000).cast("bigint").alias("read_minutes"),
              lit("").alias("notes")]
    extract = F.to_json(F.struct(title_zh.alias("title_zh"), first_line.alias("title_en"), *common))
    rev_flag = i % 3 == 0
    review_body = F.to_json(F.struct(
        title_zh.alias("title_zh"),
        F.when(rev_flag, F.concat(first_line, lit(" (rev)"))).otherwise(first_line).alias("title_en"),
        *common,
        F.when(rev_flag, lit("title fixed")).otherwise(lit("")).alias("review_notes")))
    review = F.concat(F.expr("substring(" + "review_body" + ", 1, length(review_body) - 1)"),
                      lit(', "needs_revision": '), _bool_literal(i, rev_flag), lit("}"))
    rel = (i * 7) % 12
    qual = F.col("quality") * 5 + i % 6
    rel_part = F.when(i % 67 == 0, lit("")).otherwise(
        F.concat(lit('"relevance_score": '), _int_literal(i, rel), lit(", ")))
    score = F.concat(lit("{"), rel_part, lit('"quality_score": '), qual.cast("string"),
                     lit(', "reason": "r"}'))
    tag = F.concat(lit('{"tag": "'), _pick(i % 6, MODEL_TAGS), lit('", "tag_reason": "because"}'))
    null = lit(None).cast("string")
    base = x.select(i, extract.alias("extract"), review_body.alias("review_body"),
                    "quality", "text", "lang", "source", "n_chars").withColumn("review", review)
    # one projection per stage: a filter on ``node`` prunes the other branches
    per_node = [
        ("extract", F.when(i % 13 != 0, F.col("extract")).otherwise(null),
         F.when(i % 13 == 0, lit("model timeout")).otherwise(null)),
        ("score", score, null),
        ("generate_tag", tag, null),
        ("review", F.when(i % 17 == 0, lit('{"title_zh": ')).otherwise(F.col("review")), null),
    ]
    out = None
    for node, response, error in per_node:
        part = base.select(i, lit(node).alias("node"), response.alias("response"),
                           error.alias("error"))
        out = part if out is None else out.unionByName(part)
    return out


def repeated_answers(spark: SparkSession, d: str) -> DataFrame:
    """The stand-in answers, some of them twice: failed copies of all, and equal
    copies of the answers of every fifth document."""
    r = responses(spark, d)
    failed = r.withColumns({"response": lit(None).cast("string"), "error": lit("asked again")})
    return r.unionByName(failed.where("error is not null and node <> 'extract'")).unionByName(
        r.where(F.col("doc_id") % 5 == 0))


def link_answers(spark: SparkSession, d: str) -> DataFrame:
    """Score answers keyed by the hash of the link they are for."""
    r = responses(spark, d).where("node = 'score'")
    return links(spark, d).join(r, F.col("pos") == F.col("doc_id")).select(
        url_hash("url").alias("hash_code"), "node", "response", "error")


def unchecked_rows(spark: SparkSession, d: str) -> DataFrame:
    """Store rows of all documents, some of which fail each check."""
    s = scraped(spark, d)
    i = F.col("doc_id")
    return s.select(
        i, F.when(i % 11 == 0, lit(None)).when(i % 12 == 0, lit("")).otherwise(url_hash("article_url")).alias("hash_code"),
        F.when(i % 13 != 0, F.col("article_url")).alias("article_url"),
        F.when(i % 17 == 0, lit("ARCHIVED")).when(i % 18 == 0, lit(None)).otherwise(lit("REVIEWING")).alias("status"),
        F.when(i % 19 == 0, lit("GOSSIP")).when(i % 2 == 0, lit("VISA")).alias("tag"))


def incomplete_sources(spark: SparkSession, d: str) -> DataFrame:
    """Whitelist entries, some without a URL or a name."""
    n = F.length("name")
    s = sources(spark, d)
    return s.withColumns({"url": F.when(n % 3 == 0, lit(None)).when(n % 5 == 0, lit("")).otherwise(F.col("url")),
                          "name": F.when(n % 4 == 0, lit(None)).when(n % 7 == 0, lit("")).otherwise(F.col("name"))})


# F6 -------------------------------------------------------------------------
def _uid_cell(i: Column, u: Column) -> Column:
    k = i % 5
    return (F.when(k == 0, F.concat(lit('"'), u, lit('"')))
            .when(k == 1, F.concat(lit('[{"type":"text","text":"'), F.substring(u, 1, 1),
                                   lit('"}, 7, {"type":"mention"}, {"text":"'),
                                   F.substring(u, 2, 100), lit('"}]')))
            .when(k == 2, F.concat(lit('{"text":"'), u, lit('"}')))
            .when(k == 3, u)
            .otherwise(F.concat(lit('[{"text":"'), u, lit('"}]'))))


def _status_cell(i: Column, s: Column) -> Column:
    k = i % 3
    return (F.when(k == 0, F.concat(lit('"'), s, lit('"')))
            .when(k == 1, F.concat(lit('" '), s, lit(' "')))
            .otherwise(F.concat(lit('{"text":"'), s, lit('"}'))))


def review_store(spark: SparkSession, d: str) -> DataFrame:
    """Every document as a stored article under review."""
    s = scraped(spark, d)
    return s.select(F.col("doc_id").cast("string").alias("unique_id"),
                    url_hash("article_url").alias("hash_code"),
                    _pick(F.col("doc_id") % 5, STORE_STATUS_BY_MOD5).alias("status"))


def mirror_pull(spark: SparkSession, d: str) -> DataFrame:
    """Review-table rows as pulled: (page, pos, unique_id cell, status cell); one
    for every document, a second one for every tenth."""
    doc = load(spark, d, "documents", "doc_id")
    i = F.col("doc_id")
    uid = F.when(i % 37 == 0, F.concat(lit("x"), i.cast("string"))).otherwise(i.cast("string"))
    status = (F.when(i % 41 == 0, lit("ARCHIVED")).when(i % 43 == 0, lit(""))
              .otherwise(_pick(i % 7, MIRROR_STATUS_BY_MOD7)))
    first = F.struct((i * 2).alias("pos"), uid.alias("uid"), status.alias("status"))
    second = F.struct((i * 2 + 1).alias("pos"), i.cast("string").alias("uid"),
                      F.when(i % 20 == 0, lit("DISCARD")).otherwise(lit("READY")).alias("status"))
    rows = F.when(i % 10 == 0, F.array(first, second)).otherwise(F.array(first))
    x = doc.select(i, F.inline(rows))
    return x.select((F.col("pos") / 100).cast("bigint").alias("page"), lit(True).alias("page_ok"),
                    "pos", _uid_cell(i, F.col("uid")).alias("unique_id_cell"),
                    _status_cell(i, F.col("status")).alias("status_cell"))


def plain_pull(spark: SparkSession, d: str, pos: Column, status: Column) -> DataFrame:
    """A pull with one plain row for every document whose ``status`` isn't null."""
    doc = load(spark, d, "documents", "doc_id")
    cell = lambda c: F.concat(lit('"'), c, lit('"'))
    return doc.where(status.isNotNull()).select(
        (pos / 100).cast("bigint").alias("page"), lit(True).alias("page_ok"), pos.alias("pos"),
        cell(F.col("doc_id").cast("string")).alias("unique_id_cell"), cell(status).alias("status_cell"))


def failed_pull(spark: SparkSession, d: str) -> DataFrame:
    """The mirror pull with failed pages: the scan ends at the first of them."""
    p = mirror_pull(spark, d)
    last = p.agg(F.max("page")).scalar()
    return p.withColumn("page_ok", F.col("page") <= last / 2)


# F7 -------------------------------------------------------------------------
def attempts(spark: SparkSession, d: str) -> DataFrame:
    ev = load(spark, d, "events", "event_id", "ts", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("bigint").cast("string")
    kb = F.get_json_object("props", "$.k").cast("bigint")
    m = F.col("event_id") % 4
    usage = (F.when(m == 0, F.concat(lit('{"token_usage": {"prompt_tokens": '), k,
                                     lit(', "completion_tokens": '), F.floor(kb / 2).cast("string"),
                                     lit(', "total_tokens": '), (kb + F.floor(kb / 2) + 1).cast("string"),
                                     lit("}}")))
             .when(m == 1, F.concat(lit('{"usage": {"input_tokens": '), k, lit(', "output_tokens": '),
                                    (kb % 7).cast("string"), lit("}}")))
             .when(F.col("event_id") % 8 == 6, F.concat(
                 lit('{"generations": [[{"message": {"usage_metadata": {"input_tokens": '), k,
                 lit(', "output_tokens": 5}}}], [{"usage_metadata": {"input_tokens": 2, "output_tokens": 1}}]]}')))
             .when(m == 2, F.concat(lit('{"generations": [{"usage_metadata": {"input_tokens": '), k,
                                    lit(', "output_tokens": 3}}, {"usage_metadata": {"input_tokens": 1, '
                                        '"output_tokens": 2, "total_tokens": 4}}]}')))
             .otherwise(lit('{"token_usage": {"prompt_tokens": 0, "completion_tokens": 0}}')))
    return ev.select("event_id", F.col("ts").alias("started_at"),
                     F.col("event_type").alias("stage"), F.col("value").alias("duration_sec"),
                     usage.alias("usage"))


def fetch_calls(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a fetch of one of three runs; a third of them from one source."""
    ev = load(spark, d, "events", "event_id", "user_id", "event_type", "value")
    e, u = F.col("event_id"), F.col("user_id")
    source = F.when(e % 3 == 0, lit("S0")).otherwise(F.concat(lit("S"), (1 + u % 6).cast("string")))
    return ev.select((e % 3 + e % 2).cast("string").alias("run_id"), source.alias("source_id"),
                     F.concat(lit("https://x.org/"), u.cast("string"), lit("/"), (e % 40).cast("string")).alias("url"),
                     (F.col("event_type") != "error").alias("ok"), F.col("value").alias("duration_sec"))


# F9 -------------------------------------------------------------------------
def error_log(spark: SparkSession, d: str) -> DataFrame:
    ev = load(spark, d, "events", "event_id", "user_id", "event_type").where(
        F.col("event_type") == "error")
    e = F.col("event_id")
    err = (F.when(e % 3 == 0, F.concat(lit("Rate Limit Exceeded: please retry after "),
                                       (e % 50).cast("string"), lit("s, resets later")))
           .when(e % 3 == 1, lit("rate limit reached")).otherwise(lit("timeout")))
    return ev.select(e, F.concat(lit("scrape "), F.col("user_id").cast("string")).alias("label"),
                     (e % 5).cast("int").alias("attempt"), err.alias("error"))


# Mirror snapshot before an upsert ------------------------------------------
def mirror_snapshot(spark: SparkSession, d: str, run_id: str) -> DataFrame:
    """Review records of earlier runs: a record for every third scraped
    document (keyed like this run's store rows), a duplicate record for every
    ninth, and one record per stored article."""
    s = scraped(spark, d).select("doc_id", url_hash("article_url").alias("hash_code"))
    i = F.col("doc_id")
    uid = F.substring(F.sha2(F.concat(F.col("hash_code"), lit("|"), lit(run_id)), 256), 1, 32)
    null_s, null_l, null_d = lit(None).cast("string"), lit(None).cast("bigint"), lit(None).cast("double")
    url_t = "struct<link:string,text:string>"

    def rec(pos, rid, uid_c, title, author, notes, status, tag, rel, nr, pub):
        return F.struct(pos.alias("record_pos"), rid.alias("record_id"), uid_c.alias("unique_id"),
                        title.alias("title_zh"), author.alias("author"), notes.alias("notes"),
                        status.alias("status"), tag.alias("tag"), rel.alias("relevance_score"),
                        nr.alias("needs_revision"), pub.alias("published_at"))

    prior = rec(i, F.concat(lit("rec-"), i.cast("string")), uid, lit("old title"),
                lit("prior author"), lit("prior notes"), lit("READY"), lit("CITY"), lit(1.0),
                lit(True), lit(0).cast("bigint"))
    dup = rec(i + 1000000, F.concat(lit("rec-dup-"), i.cast("string")), uid, lit("dup title"),
              lit("dup author"), null_s, null_s, null_s, null_d, lit(False), null_l)
    stored = rec(i + 2000000, F.concat(lit("rec-st-"), i.cast("string")), i.cast("string"),
                 F.concat(lit("stored "), i.cast("string")), null_s, null_s,
                 _pick(i % 5, STORE_STATUS_BY_MOD5), null_s, null_d, lit(False), null_l)
    recs = F.filter(F.array(F.when(i % 3 == 0, prior), F.when(i % 9 == 0, dup),
                            F.when(i % 4 == 0, stored)), lambda x: x.isNotNull())
    x = s.select(F.inline(recs))
    cells = {}
    for n, t in MIRROR_FIELDS:
        if n in x.columns:
            continue
        if t == 15:
            cells[n] = lit(None).cast(url_t)
        elif t in (2,):
            cells[n] = null_d
        elif t == 5:
            cells[n] = null_l
        elif t == 7:
            cells[n] = lit(False)
        else:
            cells[n] = null_s
    x = x.withColumns(cells)
    return x.select("record_id", "record_pos", *[n for n, _ in MIRROR_FIELDS])


# Tag changes ------------------------------------------------------------------
STORE_TAG_BY_MOD5 = ("MARKET", "MENTOR", "REPORT", "VISA", "CITY")


def store_tags(spark: SparkSession, d: str) -> DataFrame:
    """The stored articles' current tags."""
    doc = load(spark, d, "documents", "doc_id")
    return doc.select(F.col("doc_id").cast("string").alias("unique_id"),
                      _pick(F.col("doc_id") % 5, STORE_TAG_BY_MOD5).alias("tag"),
                      lit("2026-01-01T00:00:00").alias("updated_at"))


def tag_changes(spark: SparkSession, d: str) -> DataFrame:
    """Editor re-tags of every document: clears, invalid values, unknown ids,
    later overrides at lower positions."""
    doc = load(spark, d, "documents", "doc_id")
    i = F.col("doc_id")
    uid = F.when(i % 9 == 0, F.concat(lit("x"), i.cast("string"))).otherwise(i.cast("string"))
    value = (F.when(i % 3 == 0, lit(None).cast("string")).when(i % 7 == 0, lit("GOSSIP"))
             .otherwise(_pick(F.floor(i / 8) % 5, STORE_TAG_BY_MOD5)))
    first = F.struct((i + 10).alias("seq"), value.alias("tag"), (i % 3 == 0).alias("is_clear"),
                     lit("2026-01-03T00:00:00").alias("changed_at"), lit("a").alias("run_id"))
    later = F.struct(i.alias("seq"), lit("VISA").alias("tag"), lit(False).alias("is_clear"),
                     lit("2026-01-04T00:00:00").alias("changed_at"), lit("b").alias("run_id"))
    rows = F.when(i % 2 == 0, F.array(first, later)).otherwise(F.array(first))
    return doc.select(uid.alias("unique_id"), F.inline(rows))


# Legacy mirror layout (schema check) ------------------------------------------
def legacy_mirror(spark: SparkSession, d: str):
    """Mirror rows in an older layout: no tag_reason, published_at kept as
    text, an extra owner field, notes never filled. Returns (rows, {field: type id})."""
    doc = load(spark, d, "documents", "doc_id", "source", "lang")
    i = F.col("doc_id")
    types = {n: t for n, t in MIRROR_FIELDS if n != "tag_reason"}
    types["published_at"] = 1
    types["owner"] = 1
    cells = {n: i.cast("string") for n in types}
    cells["author"] = F.when(i % 2 == 1, F.col("source"))
    cells["country"] = F.when(i % 3 == 0, F.upper("lang"))
    cells["owner"] = F.when(i % 5 == 0, F.col("source"))
    cells["notes"] = lit(None).cast("string")
    return doc.select(*[c.alias(n) for n, c in cells.items()]), types


# Discovery call outcomes --------------------------------------------------------
def discovery_status(spark: SparkSession, d: str) -> DataFrame:
    """Per source and mode, whether the discovery call succeeded: the default
    call fails when length(name) % 7 = 0, the sitemap call when % 5 = 0."""
    s = sources(spark, d)
    n = F.length("name")
    rows = F.array(F.struct(lit("default").alias("mode"), (n % 7 != 0).alias("ok")),
                   F.struct(lit("sitemap").alias("mode"), (n % 5 != 0).alias("ok")))
    return s.select("source_id", F.inline(rows))


# Vectors with near copies (semantic dedupe) --------------------------------------
def article_vectors(spark: SparkSession, d: str) -> DataFrame:
    """All embeddings; of every fifth a longer copy without the entries of one
    residue, of every tenth one without those of two, of every seventh an equal one."""
    base = load(spark, d, "embeddings", "vec_id", "embedding").withColumn(
        "embedding", F.col("embedding").cast("array<double>"))
    i = F.col("vec_id")

    def without(residues: int) -> Column:
        return F.transform("embedding", lambda x, at: F.when((at + i) % 12 < residues, F.lit(0.0)).otherwise(x * 1.5))

    def copies(every: int, embedding: Column) -> DataFrame:
        return base.where(i % every == 0).withColumn("embedding", embedding)

    # the id is changed in a step of its own: within one, the lambda would see the new one
    return (base.unionByName(copies(5, without(1)).withColumn("vec_id", i + 1_000_000))
            .unionByName(copies(10, without(2)).withColumn("vec_id", i + 2_000_000))
            .unionByName(base.where(i % 7 == 0).withColumn("vec_id", i + 3_000_000)))


# A model that fails by schedule ----------------------------------------------------
def failing_model(pdf):
    """Answers each row unless its document's id says that this attempt fails."""
    import pandas as pd

    def error(doc_id, attempt):
        kind = doc_id % 7
        if kind in (1, 2, 3) and attempt < kind:
            return f"Rate limit exceeded, retry after {doc_id % 11}s"
        if kind == 4:
            return "rate limit"
        return "bad request" if kind == 5 else None

    errors = [error(i, a) for i, a in zip(pdf["doc_id"], pdf["attempt"])]
    return pd.DataFrame({"doc_id": pdf["doc_id"], "node": pdf["node"], "error": errors,
                         "response": [None if e else f"answer {n}" for e, n in zip(errors, pdf["attempt"])]})
