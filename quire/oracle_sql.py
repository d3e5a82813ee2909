"""DuckDB SQL for each registered query, over the same parquet tables.

Used only to check the Spark results (the fixture derivations are rebuilt
here as CTEs). Kept in plain SQL with constants of its own, so that a wrong one
on the Spark side shows.
"""

from __future__ import annotations

# Fixed values, stated here once more -----------------------------------------
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
                 "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
ASSET_URL = r"(?i)\.(pdf|jpe?g|png|gif|svg|webp|mp4|webm|mp3|zip)(?:\?.*)?$"
HTML_STEPS = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<head\b[^>]*>.*?</head\s*>", ""),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", ""),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", ""),
    (r"(?is)<nav\b[^>]*>.*?</nav\s*>", ""),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</(p|div|h[1-6]|li|tr|article|section)\s*>", "\n"),
    (r"<[^>]*>", ""),
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
    (r"[ \t]+\n", "\n"),
    (r"\n{3,}", "\n\n"),
)
EXTRACT_PROMPT = """<SOURCE_URL>{article_url}</SOURCE_URL>
<SOURCE_NAME>{source_name}</SOURCE_NAME>
<SCRAPED_AT>{scraped_at}</SCRAPED_AT>

<ARTICLE_MARKDOWN>
{raw_markdown}
</ARTICLE_MARKDOWN>"""
SCORE_PROMPT = """<SOURCE_URL>{article_url}</SOURCE_URL>

<ARTICLE_MARKDOWN>
{raw_markdown}
</ARTICLE_MARKDOWN>"""
TAG_PROMPT = "<EXCERPT_EN>{excerpt_en}</EXCERPT_EN>"
REVIEW_PROMPT = SCORE_PROMPT + """

<EXTRACTED_FIELDS>
title_zh: {title_zh}
title_en: {title_en}
excerpt_zh: {excerpt_zh}
excerpt_en: {excerpt_en}
author: {author}
country: {country}
published_at: {published_at}
read_minutes: {read_minutes}
notes: {notes}
</EXTRACTED_FIELDS>"""
# SHA-256 of the system messages
SYSTEM_SHA = {
    "extract": "3d3aeb489e3208ff3f24bef9a03fe3a91d1bd2fab2ef4b6abd7a278a1683c7eb",
    "score": "ac06705f2a7c8df9f620b29253f2dc9b09265557dc3c04465bd4dac3e5963576",
    "generate_tag": "3b8127cab816928f1ad73a6c68bc52c8f434c7d5afe4ea52d83c72139eecaf63",
    "review": "6837f628a6ae67c1c1426c6b15f49dbdbc250d326a6d99ad89c8eb7e0739058d",
}
MIRROR_FIELDS = (
    ("title_zh", 1), ("title_en", 1), ("excerpt_zh", 1), ("excerpt_en", 1), ("unique_id", 1),
    ("hash_code", 1), ("status", 3), ("tag", 3), ("tag_reason", 1), ("article_url", 15),
    ("source_url", 15), ("source_name", 1), ("author", 1), ("country", 1), ("published_at", 5),
    ("scraped_at", 5), ("created_at", 5), ("read_minutes", 2), ("relevance_score", 2),
    ("quality_score", 2), ("overall_score", 2), ("reason", 1), ("needs_revision", 7),
    ("review_notes", 1), ("notes", 1), ("stage_errors", 1),
)

WS = "'" + PY_WHITESPACE + "'"


def norm_url(e: str) -> str:
    return f"rtrim(trim(coalesce({e}, ''), {WS}), '/')"


def url_hash(e: str) -> str:
    return f"sha256({norm_url(e)})"


HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
SEC = "regexp_extract(url, '^https?://[^/?#]+/([a-z]+)', 1)"

CTE = {
    "sources": f"""sources AS (
  SELECT 'https://' || host || '/' || sec AS source_id, host AS name,
         'https://' || host || '/' || sec AS url,
         CASE WHEN length(host) % 4 <> 0 THEN '^https?://' || replace(host, '.', '[.]') || '/'
              || sec || '/[0-9]+(?:/|$|[.]html$)' END AS url_pattern
  FROM (SELECT DISTINCT {HOST} AS host, {SEC} AS sec FROM pages))""",
    "links": f"""links AS (
  SELECT src AS source_id, src AS source_url,
         CASE WHEN page_id % 5 = 0 THEN 'sitemap' ELSE 'default' END AS mode, page_id AS pos,
         CASE WHEN page_id % 23 = 0 THEN '' WHEN page_id % 19 = 0 THEN url || '/photo.JPG?x=1'
              WHEN page_id % 17 = 0 THEN src || '/' ELSE url END AS url
  FROM (SELECT page_id, url, 'https://' || {HOST} || '/' || {SEC} AS src FROM pages))""",
    "scraped": """scraped AS (
  SELECT doc_id, source AS source_name, 'https://' || source || '.example.org/' || lang AS source_url,
         CASE WHEN doc_id % 7 = 0 THEN '  ' ELSE '' END || 'https://docs.example.org/'
           || CAST(CASE WHEN doc_id % 10 = 1 THEN doc_id - 1 ELSE doc_id END AS VARCHAR)
           || CASE WHEN doc_id % 3 = 0 THEN '/' ELSE '' END AS article_url,
         CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 31 = 0 THEN '' ELSE text END AS markdown
  FROM documents)""",
    "store": f"""store AS (
  SELECT CAST(doc_id AS VARCHAR) AS unique_id, {url_hash('article_url')} AS hash_code,
         ['READY','PUBLISHED','DISCARD','REVIEWING','REVIEWING'][doc_id % 5 + 1] AS status
  FROM scraped WHERE doc_id % 4 = 0)""",
    "review_store": f"""review_store AS (
  SELECT CAST(doc_id AS VARCHAR) AS unique_id, {url_hash('article_url')} AS hash_code,
         ['READY','PUBLISHED','DISCARD','REVIEWING','REVIEWING'][doc_id % 5 + 1] AS status
  FROM scraped)""",
    "fresh": f"""fresh AS (
  SELECT *, {url_hash('article_url')} AS hash_code FROM scraped
  WHERE markdown IS NOT NULL AND length(markdown) > 0)""",
}

DEPS = {"store": ["scraped"], "review_store": ["scraped"], "fresh": ["scraped"]}


def with_ctes(names, extra: str = "") -> str:
    order: list[str] = []

    def add(n):
        for dep in DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    parts = [CTE[n] for n in order]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


KEEP = f"""(url IS NOT NULL AND url <> ''
  AND rtrim(url, '/') <> rtrim(coalesce(source_url, ''), '/')
  AND NOT regexp_matches(url, '{ASSET_URL}')
  AND (url_pattern IS NULL OR url_pattern = '' OR coalesce(regexp_matches(url, url_pattern), false)))"""

JOINED = """joined AS (
  SELECT l.*, s.name AS source_name, s.url_pattern FROM links l JOIN sources s USING (source_id))"""
LIMITED = """limited AS (
  SELECT * FROM joined QUALIFY row_number() OVER (PARTITION BY source_id, mode ORDER BY pos, url) <= 5)"""
KEPT_LIMITED = f"""kept_limited AS (
  SELECT * FROM joined WHERE {KEEP}
  QUALIFY row_number() OVER (PARTITION BY source_id, mode ORDER BY pos, url) <= 5)"""
LINK_COLS = "source_id, source_name, mode, pos, url"

DISCOVERED = f"""discovered AS (SELECT * FROM limited WHERE {KEEP}),
fallback_links AS (
  SELECT * FROM discovered WHERE mode = 'default'
  UNION ALL
  SELECT * FROM discovered d WHERE mode = 'sitemap' AND NOT EXISTS (
    SELECT 1 FROM discovered x WHERE x.mode = 'default' AND x.source_id = d.source_id))"""


def _html_sql(col: str) -> str:
    e = col
    for pat, rep in HTML_STEPS:
        r = "'" + rep.replace("'", "''") + "'"
        r = r.replace("\n", "' || chr(10) || '")
        e = f"regexp_replace({e}, '{pat.replace(chr(39), chr(39) * 2)}', {r}, 'g')"
    return f"trim({e}, ' ' || chr(9) || chr(10) || chr(13))"


SQL: dict[str, str] = {}

SQL["source_prepare"] = with_ctes(["sources"]) + \
    "SELECT source_id, name, url, url_pattern FROM sources WHERE url IS NOT NULL AND url <> ''"

SQL["sources_incomplete"] = with_ctes(["sources"]) + """
SELECT source_id, CASE WHEN length(name) % 4 = 0 THEN NULL WHEN length(name) % 7 = 0 THEN '' ELSE name END AS name,
  url, url_pattern
FROM sources WHERE length(name) % 3 <> 0 AND length(name) % 5 <> 0"""

SQL["url_filter"] = with_ctes(["sources", "links"], JOINED) + \
    f"SELECT {LINK_COLS} FROM joined WHERE {KEEP}"

SQL["discover_limit"] = with_ctes(["sources", "links"], JOINED + ",\n" + LIMITED) + \
    f"SELECT {LINK_COLS} FROM limited WHERE {KEEP}"

SQL["discover_kept_limit"] = with_ctes(["sources", "links"], JOINED + ",\n" + KEPT_LIMITED) + \
    f"SELECT {LINK_COLS} FROM kept_limited"

SQL["discover_with_fallback"] = with_ctes(
    ["sources", "links"], JOINED + ",\n" + LIMITED + ",\n" + DISCOVERED) + \
    f"SELECT {LINK_COLS} FROM fallback_links"

SQL["discover_counts"] = with_ctes(["sources", "links"], JOINED + ",\n" + LIMITED) + f"""
, per AS (
  SELECT source_id,
    CAST(count_if(mode = 'default') AS BIGINT) AS d_disc,
    CAST(count_if(mode = 'default' AND {KEEP}) AS BIGINT) AS d_kept,
    CAST(count_if(mode = 'sitemap') AS BIGINT) AS s_disc,
    CAST(count_if(mode = 'sitemap' AND {KEEP}) AS BIGINT) AS s_kept
  FROM limited GROUP BY source_id)
SELECT s.source_id, s.name, coalesce(d_kept, 0) = 0 AS used_fallback,
  CAST(CASE WHEN coalesce(d_kept, 0) = 0 THEN coalesce(s_disc, 0) ELSE coalesce(d_disc, 0) END AS BIGINT) AS discovered,
  CAST(CASE WHEN coalesce(d_kept, 0) = 0 THEN coalesce(s_kept, 0) ELSE coalesce(d_kept, 0) END AS BIGINT) AS kept
FROM sources s LEFT JOIN per USING (source_id)"""

SQL["scrape_join"] = with_ctes(["sources", "links"], JOINED + ",\n" + LIMITED + ",\n" + DISCOVERED) + f"""
, fetched AS (
  SELECT f.source_id, f.pos, f.source_name, f.source_url, f.url AS article_url,
         {_html_sql('p.html')} AS markdown
  FROM fallback_links f LEFT JOIN pages p ON p.url = f.url)
SELECT source_id, pos, source_name, source_url, article_url,
       sha256(coalesce(markdown, '<null>')) AS markdown_sha, CAST(length(markdown) AS INTEGER) AS markdown_chars
FROM fetched"""

SQL["drop_empty_body"] = with_ctes(["scraped"]) + """
SELECT doc_id, source_name, source_url, article_url, CAST(length(markdown) AS INTEGER) AS markdown_chars
FROM scraped WHERE markdown IS NOT NULL AND length(markdown) > 0"""

SQL["page_text"] = f"""
SELECT page_id, sha256(t) AS text_sha, CAST(length(t) AS INTEGER) AS n_chars
FROM (SELECT page_id, {_html_sql('html')} AS t FROM pages)"""

SQL["hash_urls"] = with_ctes(["links"]) + f"SELECT source_id, pos, url, {url_hash('url')} AS hash_code FROM links"

SQL["dedupe_new"] = with_ctes(["fresh", "store"]) + """
SELECT doc_id, article_url, hash_code FROM fresh
WHERE hash_code NOT IN (SELECT hash_code FROM store)"""

SQL["existing_hashes"] = with_ctes(["fresh", "store"]) + """
SELECT DISTINCT hash_code FROM fresh
WHERE hash_code <> '' AND hash_code IN (SELECT hash_code FROM store)"""

SQL["dedupe_counts"] = with_ctes(["fresh", "store"]) + """
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count_if(hash_code IN (SELECT hash_code FROM store)) AS BIGINT) AS skipped,
       CAST(count(*) - count_if(hash_code IN (SELECT hash_code FROM store)) AS BIGINT) AS new
FROM fresh"""

NEW_UNIQUE = """new_rows AS (
  SELECT * FROM fresh WHERE hash_code NOT IN (SELECT hash_code FROM store)),
ranked AS (
  SELECT *, doc_id = min(doc_id) OVER (PARTITION BY hash_code) AS kept FROM new_rows)"""

SQL["batch_unique"] = with_ctes(["fresh", "store"], NEW_UNIQUE) + \
    "SELECT doc_id, hash_code, kept FROM ranked"



# enrichment ---------------------------------------------------------------------
RUN_TS = "2026-01-01T00:00:00"
RUN_ID = "20260101_000000"
SYNC_TS = "2026-01-02T00:00:00"
TAG_LIST = "['MARKET','MENTOR','REPORT','VISA','CITY']"
EXTRACT_F = ("title_zh", "title_en", "excerpt_zh", "excerpt_en", "author", "country",
             "published_at", "read_minutes", "notes")


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def render_sql(template: str, cols: dict[str, str]) -> str:
    import re
    out = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            out.append(f"CAST({cols[piece]} AS VARCHAR)")
        elif piece:
            out.append(_lit(piece))
    return "(" + " || ".join(out) + ")"


def _pad2(e: str) -> str:
    return f"lpad(CAST({e} AS VARCHAR), 2, '0')"


PUB = f"""CASE doc_id % 6
  WHEN 0 THEN ds WHEN 1 THEN ds || 'T' || hm WHEN 2 THEN ds || ' ' || hm
  WHEN 3 THEN ds || 'T' || hm || 'Z' WHEN 4 THEN '' ELSE 'unknown' END"""


def _int_lit(v: str) -> str:
    s = f"CAST({v} AS VARCHAR)"
    return f"""CASE WHEN doc_id % 53 = 0 THEN {s} || '.5'
  WHEN doc_id % 59 = 0 THEN '"' || {s} || '.50"'
  WHEN doc_id % 61 = 0 THEN 'null'
  WHEN doc_id % 8 = 1 THEN '"' || {s} || '"'
  WHEN doc_id % 8 = 2 THEN '" ' || {s} || ' "'
  WHEN doc_id % 8 = 3 THEN {s} || '.0'
  WHEN doc_id % 8 = 4 THEN '"' || {s} || '.0"'
  ELSE {s} END"""


BOOL_LIT = """CASE WHEN doc_id % 47 = 0 THEN '2' WHEN doc_id % 43 = 0 THEN '"x"'
  WHEN doc_id % 4 = 0 THEN CASE WHEN doc_id % 3 = 0 THEN 'true' ELSE 'false' END
  WHEN doc_id % 4 = 1 THEN CASE WHEN doc_id % 3 = 0 THEN '"yes"' ELSE '"no"' END
  WHEN doc_id % 4 = 2 THEN CASE WHEN doc_id % 3 = 0 THEN '1' ELSE '0' END
  ELSE CASE WHEN doc_id % 3 = 0 THEN '"true"' ELSE '"0"' END END"""

COMMON_JSON = """excerpt_zh := first_line, excerpt_en := text, author := source,
  country := upper(lang), published_at := published_at, read_minutes := CAST(n_chars // 1000 AS BIGINT),
  notes := ''"""

CTE["responses"] = f"""resp_base AS (
  SELECT *, {PUB} AS published_at FROM (
    SELECT l.doc_id, l.quality, d.text, d.lang, d.source, d.n_chars,
      regexp_extract(d.text, '^[^\\n]*', 0) AS first_line,
      '2025-' || {_pad2('1 + l.doc_id % 12')} || '-' || {_pad2('1 + l.doc_id % 28')} AS ds,
      {_pad2('l.doc_id % 24')} || ':' || {_pad2('l.doc_id % 60')} || ':05' AS hm
    FROM labels l JOIN documents d USING (doc_id))),
responses AS (
  SELECT doc_id, 'extract' AS node,
    CASE WHEN doc_id % 13 <> 0 THEN CAST(to_json(struct_pack(
      title_zh := '[' || lang || '] ' || first_line, title_en := first_line, {COMMON_JSON})) AS VARCHAR)
    END AS response,
    CASE WHEN doc_id % 13 = 0 THEN 'model timeout' END AS error
  FROM resp_base
  UNION ALL
  SELECT doc_id, 'score',
    '{{' || CASE WHEN doc_id % 67 = 0 THEN '' ELSE '"relevance_score": ' || ({_int_lit('(doc_id * 7) % 12')}) || ', ' END
    || '"quality_score": ' || CAST(quality * 5 + doc_id % 6 AS VARCHAR) || ', "reason": "r"}}', NULL
  FROM resp_base
  UNION ALL
  SELECT doc_id, 'generate_tag',
    '{{"tag": "' || ['MARKET','MENTOR','REPORT','VISA','CITY','OTHER'][doc_id % 6 + 1]
    || '", "tag_reason": "because"}}', NULL
  FROM resp_base
  UNION ALL
  SELECT doc_id, 'review',
    CASE WHEN doc_id % 17 = 0 THEN '{{"title_zh": '
         ELSE substring(rb, 1, length(rb) - 1) || ', "needs_revision": ' || ({BOOL_LIT}) || '}}' END, NULL
  FROM (SELECT *, CAST(to_json(struct_pack(
      title_zh := '[' || lang || '] ' || first_line,
      title_en := CASE WHEN doc_id % 3 = 0 THEN first_line || ' (rev)' ELSE first_line END,
      {COMMON_JSON},
      review_notes := CASE WHEN doc_id % 3 = 0 THEN 'title fixed' ELSE '' END)) AS VARCHAR) AS rb
    FROM resp_base))"""

CTE["articles"] = f"""new_rows AS (
  SELECT * FROM fresh WHERE hash_code NOT IN (SELECT hash_code FROM store)),
ranked AS (
  SELECT *, doc_id = min(doc_id) OVER (PARTITION BY hash_code) AS kept FROM new_rows),
articles AS (
  SELECT doc_id, hash_code, article_url, source_name, source_url, markdown AS raw_markdown,
         '{RUN_TS}' AS scraped_at
  FROM ranked WHERE kept)"""
DEPS["articles"] = ["fresh", "store"]

PREFIX = {"extract": "ex", "score": "sc", "generate_tag": "tg", "review": "rv"}
NODE_FIELDS = {
    "extract": [(f, "int" if f == "read_minutes" else "str") for f in EXTRACT_F],
    "score": [("relevance_score", "score"), ("quality_score", "score"), ("reason", "str")],
    "generate_tag": [("tag", "tag"), ("tag_reason", "str")],
    "review": [(f, "int" if f == "read_minutes" else "str") for f in EXTRACT_F]
    + [("needs_revision", "bool"), ("review_notes", "str")],
}
INT_TEXT = r"^\s*[+-]?[0-9]+(\.0+)?\s*$"


def _raw(kind: str, f: str) -> str:
    k = f"json_type(j, '$.{f}')"
    s = f"json_extract_string(j, '$.{f}')"
    d = f"TRY_CAST({s} AS DOUBLE)"
    if kind in ("str", "tag"):
        return f"CASE WHEN {k} = 'VARCHAR' THEN {s} END"
    if kind in ("int", "score"):
        return f"""TRY_CAST(CASE
      WHEN {k} IN ('UBIGINT', 'BIGINT') THEN TRY_CAST({s} AS BIGINT)
      WHEN {k} = 'BOOLEAN' THEN CASE WHEN {s} = 'true' THEN 1 ELSE 0 END
      WHEN {k} = 'DOUBLE' AND {d} = floor({d}) THEN TRY_CAST({d} AS BIGINT)
      WHEN {k} = 'VARCHAR' AND regexp_matches({s}, '{INT_TEXT}')
        THEN TRY_CAST(TRY_CAST(trim({s}) AS DOUBLE) AS BIGINT) END AS INTEGER)"""
    return f"""CASE
      WHEN {k} = 'BOOLEAN' THEN {s} = 'true'
      WHEN {k} IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND {d} IN (0, 1) THEN {d} = 1
      WHEN {k} = 'VARCHAR' AND lower({s}) IN ('1','on','t','true','y','yes') THEN true
      WHEN {k} = 'VARCHAR' AND lower({s}) IN ('0','off','f','false','n','no') THEN false END"""


def _ferr(kind: str, f: str) -> str:
    k = f"json_type(j, '$.{f}')"
    e = f"CASE WHEN {k} IS NULL THEN 'missing:{f}' WHEN r_{f} IS NULL THEN 'type:{f}'"
    if kind == "score":
        e += f" WHEN r_{f} < 0 OR r_{f} > 10 THEN 'range:{f}'"
    if kind == "tag":
        e += f" WHEN r_{f} NOT IN ('MARKET','MENTOR','REPORT','VISA','CITY') THEN 'enum:{f}'"
    return e + " END"


def decode_cte(node: str) -> str:
    p = PREFIX[node]
    spec = NODE_FIELDS[node]
    raws = ", ".join(f"{_raw(k, f)} AS r_{f}" for f, k in spec)
    errs = ", ".join(_ferr(k, f) for f, k in spec)
    outs = ", ".join(f"CASE WHEN err IS NULL THEN r_{f} END AS {p}_{f}" for f, _ in spec)
    if node == "score":
        outs += (", CASE WHEN err IS NULL THEN CAST(round_even((r_relevance_score + r_quality_score)"
                 " / 2.0, 0) AS INTEGER) END AS sc_overall_score")
    return f"""dec_{p} AS (
  SELECT doc_id, {outs}, err AS {p}_err, true AS {p}_present FROM (
    SELECT *, coalesce(error, CASE WHEN response IS NULL THEN 'missing_response'
                                   WHEN j IS NULL THEN 'invalid_json' END, {errs}) AS err
    FROM (SELECT *, {raws} FROM (
      SELECT doc_id, response, error, CASE WHEN json_valid(response) THEN response END AS j
      FROM responses WHERE node = '{node}'))))"""


for _n in PREFIX:
    CTE[f"dec_{PREFIX[_n]}"] = decode_cte(_n)
    DEPS[f"dec_{PREFIX[_n]}"] = ["responses"]


def _attached(nodes=("extract", "score", "generate_tag", "review")) -> str:
    joins = " ".join(f"LEFT JOIN dec_{PREFIX[n]} USING (doc_id)" for n in nodes)
    fix = ", ".join(f"CASE WHEN {PREFIX[n]}_present IS NULL THEN 'missing_response' "
                    f"ELSE {PREFIX[n]}_err END AS {PREFIX[n]}_e" for n in nodes)
    return f"SELECT a.*, dec_all.* EXCLUDE (doc_id) FROM articles a" if False else \
        f"(SELECT *, {fix} FROM articles {joins})"


def merged_cte(mode: str, name: str = "merged") -> str:
    alive = "ex_e IS NULL" if mode == "collapse" else "true"
    cols = []
    for f in EXTRACT_F:
        cols.append(f"CASE WHEN {alive} THEN CASE WHEN rv_e IS NULL THEN rv_{f} ELSE ex_{f} END END AS {f}")
    for f in ("relevance_score", "quality_score", "overall_score", "reason"):
        cols.append(f"CASE WHEN {alive} AND sc_e IS NULL THEN sc_{f} END AS {f}")
    for f in ("tag", "tag_reason"):
        cols.append(f"CASE WHEN {alive} AND ex_e IS NULL AND tg_e IS NULL THEN tg_{f} END AS {f}")
    for f in ("needs_revision", "review_notes"):
        cols.append(f"CASE WHEN {alive} AND rv_e IS NULL THEN rv_{f} END AS {f}")
    errs = ("list_filter([{'node': 'extract', 'error': ex_e}, {'node': 'score', 'error': sc_e}, "
            "{'node': 'generate_tag', 'error': CASE WHEN ex_e IS NOT NULL THEN 'missing:excerpt_en' "
            "ELSE tg_e END}, {'node': 'review', 'error': rv_e}], lambda x: x.error IS NOT NULL)")
    cols.append(f"CASE WHEN NOT ({alive}) THEN [{{'node': 'ainvoke', 'error': '''excerpt_en'''}}] "
                f"ELSE {errs} END AS stage_errors_list")
    return f"""{name} AS (
  SELECT doc_id, hash_code, article_url, source_name, source_url, raw_markdown, scraped_at,
    {", ".join(cols)}
  FROM {_attached()})"""


ENRICH_DEPS = ["articles", "dec_ex", "dec_sc", "dec_tg", "dec_rv"]
ENRICHED_OUT = ("doc_id, hash_code, " + ", ".join(EXTRACT_F) + ", tag, tag_reason, relevance_score, "
                "quality_score, overall_score, reason, needs_revision, review_notes, "
                "CAST(to_json(stage_errors_list) AS VARCHAR) AS stage_errors, "
                "array_to_string(list_transform(stage_errors_list, lambda x: coalesce(x.node, '?')), ',')"
                " AS error_nodes")

SQL["enrich_collapse"] = with_ctes(ENRICH_DEPS, merged_cte("collapse")) + \
    f"SELECT {ENRICHED_OUT} FROM merged"
SQL["enrich_accumulate"] = with_ctes(ENRICH_DEPS, merged_cte("accumulate")) + \
    f"SELECT {ENRICHED_OUT} FROM merged"


def _prompt(expr: str, src: str, node: str) -> str:
    return (f"SELECT doc_id, sha256(p) AS prompt_sha, CAST(length(p) AS INTEGER) AS prompt_chars, "
            f"'{SYSTEM_SHA[node]}' AS system_sha FROM (SELECT doc_id, {expr} AS p FROM {src})")


SQL["requests_extract"] = with_ctes(["articles"]) + _prompt(render_sql(EXTRACT_PROMPT, {
    "article_url": "article_url", "source_name": "coalesce(source_name, '')",
    "scraped_at": "coalesce(scraped_at, '')", "raw_markdown": "raw_markdown"}), "articles", "extract")
SQL["requests_score"] = with_ctes(["articles"]) + _prompt(render_sql(SCORE_PROMPT, {
    "article_url": "article_url", "raw_markdown": "raw_markdown"}), "articles", "score")
_EX_OK = "(SELECT * FROM articles JOIN dec_ex USING (doc_id) WHERE ex_err IS NULL)"
SQL["requests_tag"] = with_ctes(["articles", "dec_ex"]) + _prompt(
    render_sql(TAG_PROMPT, {"excerpt_en": "ex_excerpt_en"}), _EX_OK, "generate_tag")
_rv_cols = {f: f"coalesce(CAST(ex_{f} AS VARCHAR), '{'0' if f == 'read_minutes' else ''}')"
            for f in EXTRACT_F}
_rv_cols.update(article_url="article_url", raw_markdown="raw_markdown")
SQL["requests_review"] = with_ctes(["articles", "dec_ex"]) + _prompt(
    render_sql(REVIEW_PROMPT, _rv_cols), _EX_OK, "review")

for _n in PREFIX:
    _p = PREFIX[_n]
    _names = [f for f, _ in NODE_FIELDS[_n]] + (["overall_score"] if _n == "score" else [])
    _key = {"extract": "decode_extract", "score": "decode_score", "generate_tag": "decode_tag",
            "review": "decode_review"}[_n]
    SQL[_key] = with_ctes([f"dec_{_p}"]) + "SELECT doc_id, " + ", ".join(
        f"{_p}_{f} AS {f}" for f in _names) + f", {_p}_err AS error FROM dec_{_p}"

# store ----------------------------------------------------------------------------
ARTICLE_COLS = ("unique_id", "hash_code", "status", "article_url", "source_name", "source_url",
                "scraped_at", "raw_markdown", *EXTRACT_F, "tag", "tag_reason", "relevance_score",
                "quality_score", "overall_score", "reason", "needs_revision", "review_notes",
                "stage_errors", "created_at", "updated_at")

STORE_ROWS = f"""store_rows_all AS (
  SELECT substring(sha256(hash_code || '|' || '{RUN_ID}'), 1, 32) AS unique_id, hash_code,
    'REVIEWING' AS status, article_url, source_name, source_url, scraped_at, raw_markdown,
    {", ".join(EXTRACT_F)}, tag, tag_reason, relevance_score, quality_score, overall_score, reason,
    CASE WHEN needs_revision IS NULL THEN NULL WHEN needs_revision THEN 1 ELSE 0 END AS needs_revision,
    review_notes, CAST(to_json(stage_errors_list) AS VARCHAR) AS stage_errors,
    '{RUN_TS}' AS created_at, '{RUN_TS}' AS updated_at, '{RUN_ID}' AS run_id, doc_id,
    CASE WHEN hash_code IS NULL OR hash_code = '' THEN 'missing_hash'
         WHEN article_url IS NULL THEN 'missing_url'
         WHEN tag IS NOT NULL AND tag NOT IN ('MARKET','MENTOR','REPORT','VISA','CITY') THEN 'bad_tag'
    END AS reject_reason
  FROM merged),
store_rows AS (SELECT * EXCLUDE (reject_reason) FROM store_rows_all WHERE reject_reason IS NULL)"""

SQL["store_rows"] = with_ctes(ENRICH_DEPS, merged_cte("collapse") + ",\n" + STORE_ROWS) + \
    "SELECT " + ", ".join(ARTICLE_COLS) + ", run_id, doc_id FROM store_rows"
SQL["store_rejects"] = with_ctes(ENRICH_DEPS, merged_cte("collapse") + ",\n" + STORE_ROWS) + """
SELECT doc_id, hash_code, reject_reason FROM store_rows_all WHERE reject_reason IS NOT NULL
UNION ALL
SELECT doc_id, hash_code, 'duplicate_hash' FROM ranked WHERE NOT kept"""


SQL["store_checks"] = with_ctes(["scraped"]) + """
SELECT doc_id, CASE WHEN doc_id % 11 = 0 OR doc_id % 12 = 0 THEN 'missing_hash' WHEN doc_id % 13 = 0 THEN 'missing_url'
  WHEN doc_id % 17 = 0 OR doc_id % 18 = 0 THEN 'bad_status' WHEN doc_id % 19 = 0 THEN 'bad_tag' END AS reject_reason
FROM scraped"""
SQL["short_ids"] = with_ctes(["store"]) + "SELECT unique_id, substring(hash_code, 1, 8) AS short_hash FROM store"


# mirror ---------------------------------------------------------------------------
def trunc(e: str, n: int = 1900) -> str:
    return (f"CASE WHEN {e} IS NULL OR {e} = '' THEN '' WHEN length({e}) <= {n} THEN {e} "
            f"ELSE rtrim(substring({e}, 1, {n - 3}), {WS}) || '...' END")


def epoch_ms(e: str) -> str:
    x = f"regexp_replace(trim({e}, {WS}), '\\s+', ' ', 'g')"
    return f"""(SELECT CASE WHEN x IS NULL OR x = '' THEN NULL ELSE epoch_ms(coalesce(
      try_strptime(x, '%Y-%m-%dT%H:%M:%S'), try_strptime(x, '%Y-%m-%d %H:%M:%S'),
      try_strptime(x, '%Y-%m-%d'), TRY_CAST(replace(x, 'Z', '+00:00') AS TIMESTAMPTZ))) END
      FROM (SELECT {x} AS x))"""


MIRROR_TEXT = ("title_en", "excerpt_zh", "excerpt_en", "unique_id", "hash_code", "tag_reason",
               "source_name", "author", "country", "reason", "review_notes", "notes")
FLAT_NAMES = []
for _name, _t in MIRROR_FIELDS:
    FLAT_NAMES += [f"{_name}_link", f"{_name}_text"] if _t == 15 else [_name]


def mirror_cells() -> str:
    c = {"title_zh": trunc("coalesce(nullif(title_zh, ''), nullif(article_url, ''), 'Untitled')")}
    for k in MIRROR_TEXT:
        c[k] = f"CASE WHEN CAST({k} AS VARCHAR) <> '' THEN {trunc(f'CAST({k} AS VARCHAR)')} END"
    c["status"] = "CASE WHEN status IN ('REVIEWING','READY','PUBLISHED','DISCARD') THEN status END"
    c["tag"] = "CASE WHEN tag IN ('MARKET','MENTOR','REPORT','VISA','CITY') THEN tag END"
    for k in ("article_url", "source_url"):
        c[f"{k}_link"] = f"CASE WHEN {k} <> '' THEN {k} END"
        c[f"{k}_text"] = f"CASE WHEN {k} <> '' THEN {k} END"
    for k in ("published_at", "scraped_at", "created_at"):
        c[k] = epoch_ms(k)
    for k in ("read_minutes", "relevance_score", "quality_score", "overall_score"):
        c[k] = f"TRY_CAST({k} AS DOUBLE)"
    c["needs_revision"] = "coalesce(CAST(needs_revision AS BOOLEAN), false)"
    c["stage_errors"] = trunc("coalesce(stage_errors, '[]')")
    return ", ".join(f"{c[n]} AS {n}" for n in FLAT_NAMES)


MIRROR_INC = f"inc AS (SELECT {mirror_cells()} FROM store_rows)"
MIRROR_BASE = ENRICH_DEPS
MIRROR_PRE = merged_cte("collapse") + ",\n" + STORE_ROWS + ",\n" + MIRROR_INC

SQL["mirror_fields"] = with_ctes(MIRROR_BASE, MIRROR_PRE) + "SELECT * FROM inc"


def _null_cells(present: dict[str, str]) -> str:
    out = []
    for n in FLAT_NAMES:
        out.append(f"{present.get(n, 'NULL')} AS {n}")
    return ", ".join(out)


_STORE_STATUS = "['READY','PUBLISHED','DISCARD','REVIEWING','REVIEWING'][doc_id % 5 + 1]"
_UID = f"substring(sha256(hash_code || '|' || '{RUN_ID}'), 1, 32)"
SNAPSHOT = f"""snap_base AS (SELECT doc_id, {url_hash('article_url')} AS hash_code FROM scraped),
snapshot AS (
  SELECT 'rec-' || CAST(doc_id AS VARCHAR) AS record_id, doc_id AS record_pos, {_null_cells({
    'unique_id': _UID, 'title_zh': "'old title'", 'author': "'prior author'",
    'notes': "'prior notes'", 'status': "'READY'", 'tag': "'CITY'",
    'relevance_score': 'CAST(1.0 AS DOUBLE)', 'needs_revision': 'true',
    'published_at': 'CAST(0 AS BIGINT)'})}
  FROM snap_base WHERE doc_id % 3 = 0
  UNION ALL
  SELECT 'rec-dup-' || CAST(doc_id AS VARCHAR), doc_id + 1000000, {_null_cells({
    'unique_id': _UID, 'title_zh': "'dup title'", 'author': "'dup author'",
    'needs_revision': 'false'})}
  FROM snap_base WHERE doc_id % 9 = 0
  UNION ALL
  SELECT 'rec-st-' || CAST(doc_id AS VARCHAR), doc_id + 2000000, {_null_cells({
    'unique_id': 'CAST(doc_id AS VARCHAR)', 'title_zh': "'stored ' || CAST(doc_id AS VARCHAR)",
    'status': _STORE_STATUS, 'needs_revision': 'false'})}
  FROM snap_base WHERE doc_id % 4 = 0)"""

ALWAYS = {"title_zh", "needs_revision", "stage_errors"}


def _upsert_cols() -> str:
    out = []
    for n in FLAT_NAMES:
        base = n.rsplit("_", 1)[0] if n.endswith(("_link", "_text")) else n
        if base in ALWAYS:
            out.append(f"CASE WHEN i.unique_id IS NOT NULL THEN i.{n} ELSE s.{n} END AS {n}")
        else:
            out.append(f"CASE WHEN i.unique_id IS NOT NULL THEN coalesce(i.{n}, s.{n}) ELSE s.{n} END AS {n}")
    return ", ".join(out)


UPSERT = f"""firsts AS (
  SELECT unique_id, min(record_pos) AS record_pos FROM snapshot
  WHERE unique_id IS NOT NULL AND unique_id <> '' GROUP BY unique_id),
snap AS (
  SELECT s.*, f.unique_id IS NOT NULL AS is_first FROM snapshot s
  LEFT JOIN firsts f ON s.unique_id = f.unique_id AND s.record_pos = f.record_pos),
inc_ok AS (SELECT * FROM inc WHERE unique_id IS NOT NULL AND unique_id <> ''),
upserted AS (
  SELECT coalesce(s.record_id, 'new-' || i.unique_id) AS record_id, s.record_pos, {_upsert_cols()},
    CASE WHEN s.record_id IS NOT NULL AND i.unique_id IS NOT NULL THEN 'updated'
         WHEN i.unique_id IS NOT NULL THEN 'created' ELSE 'unchanged' END AS action
  FROM snap s FULL OUTER JOIN inc_ok i ON s.unique_id = i.unique_id AND s.is_first)"""

SQL["mirror_upsert"] = with_ctes(MIRROR_BASE, MIRROR_PRE + ",\n" + SNAPSHOT + ",\n" + UPSERT) + \
    "SELECT * FROM upserted"
SQL["mirror_actions"] = with_ctes(MIRROR_BASE, MIRROR_PRE + ",\n" + SNAPSHOT + ",\n" + UPSERT) + \
    "SELECT * FROM upserted WHERE action <> 'unchanged'"

# sync-back ------------------------------------------------------------------------
_MIRROR_STATUS = "['READY','PUBLISHED','DISCARD','REVIEWING','REVIEWING','REVIEWING','REVIEWING'][doc_id % 7 + 1]"
CTE["pull"] = f"""pull_rows AS (
  SELECT doc_id, doc_id * 2 AS pos,
    CASE WHEN doc_id % 37 = 0 THEN 'x' ELSE '' END || CAST(doc_id AS VARCHAR) AS uid,
    CASE WHEN doc_id % 41 = 0 THEN 'ARCHIVED' WHEN doc_id % 43 = 0 THEN '' ELSE {_MIRROR_STATUS} END AS st
  FROM documents
  UNION ALL
  SELECT doc_id, doc_id * 2 + 1, CAST(doc_id AS VARCHAR),
    CASE WHEN doc_id % 20 = 0 THEN 'DISCARD' ELSE 'READY' END
  FROM documents WHERE doc_id % 10 = 0),
pull AS (
  SELECT pos // 100 AS page, true AS page_ok, pos,
    CASE doc_id % 5 WHEN 0 THEN '"' || uid || '"'
      WHEN 1 THEN '[{{"type":"text","text":"' || substring(uid, 1, 1) || '"}}, 7, {{"type":"mention"}}, {{"text":"'
                  || substring(uid, 2, 100) || '"}}]'
      WHEN 2 THEN '{{"text":"' || uid || '"}}' WHEN 3 THEN uid
      ELSE '[{{"text":"' || uid || '"}}]' END AS unique_id_cell,
    CASE doc_id % 3 WHEN 0 THEN '"' || st || '"' WHEN 1 THEN '" ' || st || ' "'
      ELSE '{{"text":"' || st || '"}}' END AS status_cell
  FROM pull_rows)"""


def rich_text_sql(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN '' WHEN NOT json_valid({c}) THEN {c}
  WHEN json_type({c}) = 'NULL' THEN ''
  WHEN json_type({c}) = 'VARCHAR' THEN json_extract_string({c}, '$')
  WHEN json_type({c}) = 'ARRAY' THEN array_to_string(list_transform(list_filter(
    json_extract({c}, '$[*]'), lambda x: json_type(x) = 'OBJECT'),
    lambda x: coalesce(json_extract_string(x, '$.text'), '')), '')
  WHEN json_type({c}) = 'OBJECT' THEN coalesce(json_extract_string({c}, '$.text'), '')
  ELSE {c} END"""


def status_text_sql(c: str) -> str:
    scalar = f"""CASE WHEN {c} IS NULL THEN '' WHEN NOT json_valid({c}) THEN {c}
  WHEN json_type({c}) = 'NULL' THEN ''
  WHEN json_type({c}) = 'VARCHAR' THEN json_extract_string({c}, '$')
  WHEN json_type({c}) = 'BOOLEAN' THEN CASE WHEN json_extract_string({c}, '$') = 'true' THEN 'True' ELSE '' END
  WHEN TRY_CAST(json_extract_string({c}, '$') AS DOUBLE) = 0 THEN ''
  ELSE {c} END"""
    return f"""CASE WHEN json_valid({c}) AND json_type({c}) = 'OBJECT'
  THEN coalesce(json_extract_string({c}, '$.text'), '') ELSE trim({scalar}, {WS}) END"""


PULLED = f"""pulled AS (
  SELECT pos, {rich_text_sql('unique_id_cell')} AS unique_id, {status_text_sql('status_cell')} AS status
  FROM pull WHERE page < coalesce((SELECT min(page) FROM pull WHERE NOT page_ok), 9223372036854775807)),
checked AS (
  SELECT *, CASE WHEN unique_id = '' OR status = '' THEN 'blank'
    WHEN status NOT IN ('REVIEWING','READY','PUBLISHED','DISCARD') THEN 'invalid_status' END AS reject_reason
  FROM pulled),
diff_rows AS (
  SELECT c.pos, c.unique_id, s.status AS old_status, c.status AS new_status
  FROM checked c JOIN review_store s USING (unique_id)
  WHERE c.reject_reason IS NULL AND c.status <> s.status),
diffs AS (
  SELECT unique_id, old_status, arg_max(new_status, pos) AS new_status, max(pos) AS pos
  FROM diff_rows GROUP BY unique_id, old_status)"""

SQL["rich_text"] = with_ctes(["pull"]) + f"""SELECT pos, {rich_text_sql('unique_id_cell')} AS unique_id,
  {status_text_sql('status_cell')} AS status FROM pull"""
SQL["status_diff_rows"] = with_ctes(["pull", "review_store"], PULLED) + "SELECT * FROM diff_rows"
SQL["status_diff"] = with_ctes(["pull", "review_store"], PULLED) + \
    "SELECT unique_id, old_status, new_status FROM diffs"
SQL["status_rejects"] = with_ctes(["pull", "review_store"], PULLED) + \
    "SELECT pos, unique_id, status, reject_reason FROM checked WHERE reject_reason IS NOT NULL"
SQL["status_apply"] = with_ctes(["pull", "review_store"], PULLED) + f"""
SELECT s.unique_id, coalesce(d.new_status, s.status) AS status,
  CASE WHEN d.new_status IS NOT NULL THEN '{SYNC_TS}' ELSE '{RUN_TS}' END AS updated_at,
  d.new_status IS NOT NULL AS changed
FROM review_store s LEFT JOIN diffs d USING (unique_id)"""
SQL["status_failed_page"] = with_ctes(["pull"]) + f"""SELECT pos, {status_text_sql('status_cell')} AS status
FROM pull WHERE page < (SELECT floor(max(page) / 2.0) + 1 FROM pull)"""
SQL["status_paged_reader"] = SQL["status_failed_page"]
SQL["status_two_syncs"] = with_ctes(["review_store"]) + f"""
SELECT unique_id, CASE WHEN CAST(unique_id AS BIGINT) % 3 <> 0 THEN 'PUBLISHED' ELSE 'READY' END AS status,
  CASE WHEN CAST(unique_id AS BIGINT) % 3 <> 0 THEN '2026-01-03T00:00:00'
       WHEN status <> 'READY' THEN '{SYNC_TS}' ELSE '{RUN_TS}' END AS updated_at
FROM review_store"""
SQL["stream_syncback_restart"] = with_ctes(["review_store"]) + f"""
SELECT unique_id, CASE WHEN CAST(unique_id AS BIGINT) % 2 = 0 THEN 'DISCARD' ELSE 'READY' END AS status,
  CASE WHEN CAST(unique_id AS BIGINT) % 2 = 0 THEN '2026-01-03T00:00:00'
       WHEN status <> 'READY' THEN '{SYNC_TS}' ELSE '{RUN_TS}' END AS updated_at
FROM review_store"""

SQL["tag_apply"] = f"""WITH store_tags AS (
  SELECT CAST(doc_id AS VARCHAR) AS unique_id, {TAG_LIST}[doc_id % 5 + 1] AS tag,
    '2026-01-01T00:00:00' AS updated_at
  FROM documents),
changes AS (
  SELECT CASE WHEN doc_id % 9 = 0 THEN 'x' ELSE '' END || CAST(doc_id AS VARCHAR) AS unique_id,
    CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 'GOSSIP'
         ELSE {TAG_LIST}[(doc_id // 8) % 5 + 1] END AS tag,
    doc_id % 3 = 0 AS is_clear, '2026-01-03T00:00:00' AS changed_at
  FROM documents
  UNION ALL
  SELECT CASE WHEN doc_id % 9 = 0 THEN 'x' ELSE '' END || CAST(doc_id AS VARCHAR),
    'VISA', false, '2026-01-04T00:00:00'
  FROM documents WHERE doc_id % 2 = 0),
latest AS (
  SELECT unique_id, arg_max({{'new_tag': tag, 'is_clear': is_clear, 'changed_at': changed_at}}, changed_at) AS l
  FROM changes WHERE is_clear OR tag IN ('MARKET','MENTOR','REPORT','VISA','CITY')
  GROUP BY unique_id)
SELECT s.unique_id,
  CASE WHEN l.is_clear IS NOT NULL THEN CASE WHEN NOT l.is_clear THEN l.new_tag END ELSE s.tag END AS tag,
  CASE WHEN l.is_clear IS NOT NULL THEN l.changed_at ELSE s.updated_at END AS updated_at,
  l.is_clear IS NOT NULL AS changed
FROM store_tags s LEFT JOIN (SELECT unique_id, l.new_tag AS new_tag, l.is_clear AS is_clear,
  l.changed_at AS changed_at FROM latest) l USING (unique_id)"""

# schema check ---------------------------------------------------------------------
_TYPE_LABEL = ("CASE {0} WHEN 1 THEN 'text' WHEN 2 THEN 'number' WHEN 3 THEN 'single_select' "
               "WHEN 5 THEN 'datetime' WHEN 7 THEN 'checkbox' WHEN 15 THEN 'url' "
               "ELSE 'type_' || CAST({0} AS VARCHAR) END")
_legacy_types = {n: t for n, t in MIRROR_FIELDS if n != "tag_reason"}
_legacy_types["published_at"] = 1
_legacy_types["owner"] = 1
_legacy_cell = {"author": "CASE WHEN doc_id % 2 = 1 THEN source END",
                "country": "CASE WHEN doc_id % 3 = 0 THEN upper(lang) END",
                "owner": "CASE WHEN doc_id % 5 = 0 THEN source END", "notes": "NULL"}
_obs = "\n  UNION ALL\n  ".join(
    f"SELECT '{n}' AS name, {t} AS type_id, count({_legacy_cell.get(n, 'CAST(doc_id AS VARCHAR)')}) AS rows "
    f"FROM documents" for n, t in _legacy_types.items())
_exp = ", ".join(f"('{n}', {t})" for n, t in MIRROR_FIELDS)
SQL["schema_diff"] = f"""WITH observed AS (
  SELECT name, min(type_id) AS type_id, CAST(sum(rows) AS BIGINT) AS rows
  FROM ({_obs}) GROUP BY name),
expected AS (SELECT * FROM (VALUES {_exp}) t(name, type_id)),
j AS (
  SELECT coalesce(e.name, o.name) AS name, e.type_id AS exp, o.type_id AS act, o.rows
  FROM expected e FULL OUTER JOIN observed o ON e.name = o.name)
SELECT kind, name, CASE WHEN exp IS NOT NULL THEN {_TYPE_LABEL.format('exp')} END AS expected,
  CASE WHEN act IS NOT NULL THEN {_TYPE_LABEL.format('act')} END AS actual,
  coalesce(rows, 0) AS rows
FROM (SELECT *, CASE WHEN act IS NULL THEN 'missing' WHEN exp IS NULL THEN 'extra'
                     WHEN exp <> act THEN 'mismatch' END AS kind FROM j)
WHERE kind IS NOT NULL"""

# metrics --------------------------------------------------------------------------
CTE["attempts"] = """attempts_base AS (
  SELECT event_id, ts AS started_at, event_type AS stage, value AS duration_sec,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
attempts AS (
  SELECT event_id, started_at, stage, duration_sec, CASE event_id % 4
    WHEN 0 THEN '{"token_usage": {"prompt_tokens": ' || CAST(k AS VARCHAR) || ', "completion_tokens": '
      || CAST(k // 2 AS VARCHAR) || ', "total_tokens": ' || CAST(k + k // 2 + 1 AS VARCHAR) || '}}'
    WHEN 1 THEN '{"usage": {"input_tokens": ' || CAST(k AS VARCHAR) || ', "output_tokens": '
      || CAST(k % 7 AS VARCHAR) || '}}'
    WHEN 2 THEN CASE WHEN event_id % 8 = 6
      THEN '{"generations": [[{"message": {"usage_metadata": {"input_tokens": ' || CAST(k AS VARCHAR)
        || ', "output_tokens": 5}}}], [{"usage_metadata": {"input_tokens": 2, "output_tokens": 1}}]]}'
      ELSE '{"generations": [{"usage_metadata": {"input_tokens": ' || CAST(k AS VARCHAR)
      || ', "output_tokens": 3}}, {"usage_metadata": {"input_tokens": 1, "output_tokens": 2, "total_tokens": 4}}]}' END
    ELSE '{"token_usage": {"prompt_tokens": 0, "completion_tokens": 0}}' END AS usage
  FROM attempts_base)"""


def _num(path: str) -> str:
    return f"coalesce(nullif(TRY_CAST(TRY_CAST(json_extract_string(usage, '{path}') AS DOUBLE) AS BIGINT), 0), 0)"


def _block(key: str):
    i = f"coalesce(nullif({_num(f'$.{key}.prompt_tokens')}, 0), {_num(f'$.{key}.input_tokens')})"
    o = f"coalesce(nullif({_num(f'$.{key}.completion_tokens')}, 0), {_num(f'$.{key}.output_tokens')})"
    t = f"coalesce(nullif({_num(f'$.{key}.total_tokens')}, 0), ({i}) + ({o}))"
    ok = f"(coalesce(json_type(usage, '$.{key}') = 'OBJECT', false) AND (({i}) <> 0 OR ({o}) <> 0 OR ({t}) <> 0))"
    return ok, i, o, t


def _gen(field: str) -> str:
    return (f"coalesce(list_sum(list_transform(list_concat(json_extract(usage, '$.generations[*]'), "
            f"json_extract(usage, '$.generations[*][*]')), lambda g: coalesce(TRY_CAST(TRY_CAST(coalesce("
            f"json_extract_string(g, '$.usage_metadata.{field}'), "
            f"json_extract_string(g, '$.message.usage_metadata.{field}')) AS DOUBLE) AS BIGINT), 0))), 0)")


_ok1, _i1, _o1, _t1 = _block("token_usage")
_ok2, _i2, _o2, _t2 = _block("usage")
_gi, _go, _gt = _gen("input_tokens"), _gen("output_tokens"), _gen("total_tokens")
CTE["usage"] = f"""usage_rows AS (
  SELECT *,
    CAST(CASE WHEN {_ok1} THEN {_i1} WHEN {_ok2} THEN {_i2} ELSE {_gi} END AS BIGINT) AS input_tokens,
    CAST(CASE WHEN {_ok1} THEN {_o1} WHEN {_ok2} THEN {_o2} ELSE {_go} END AS BIGINT) AS output_tokens,
    CAST(CASE WHEN {_ok1} THEN {_t1} WHEN {_ok2} THEN {_t2}
         ELSE coalesce(nullif({_gt}, 0), ({_gi}) + ({_go})) END AS BIGINT) AS total_tokens
  FROM attempts)"""
DEPS["usage"] = ["attempts"]

SQL["token_usage"] = with_ctes(["usage"]) + \
    "SELECT event_id, stage, input_tokens, output_tokens, total_tokens FROM usage_rows"
SQL["stage_metrics"] = with_ctes(["usage"]) + """
SELECT stage, count(duration_sec) AS count, round(coalesce(sum(duration_sec), 0.0), 3) AS total_time_sec,
  round(CASE WHEN count(duration_sec) > 0 THEN coalesce(sum(duration_sec), 0.0) / count(duration_sec)
             ELSE 0.0 END, 3) AS avg_time_sec,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens
FROM usage_rows GROUP BY stage"""
SQL["stage_rollup"] = with_ctes(["usage"]) + """
SELECT stage, count(duration_sec) AS count, round(coalesce(sum(duration_sec), 0.0), 3) AS total_time_sec,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens
FROM usage_rows GROUP BY ROLLUP (stage)"""
SQL["run_totals"] = with_ctes(["usage"]) + """
SELECT count(DISTINCT stage) AS stages, count(duration_sec) AS calls,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
  round((max(epoch_us(started_at) + CAST(trunc(duration_sec * 1e6) AS BIGINT)) - min(epoch_us(started_at)))
        / 1e6, 3) AS wall_clock_sec
FROM usage_rows"""

SQL["retry_plan"] = """WITH errs AS (
  SELECT event_id, 'scrape ' || CAST(user_id AS VARCHAR) AS label, CAST(event_id % 5 AS INTEGER) AS attempt,
    CASE WHEN event_id % 3 = 0 THEN 'Rate Limit Exceeded: please retry after ' || CAST(event_id % 50 AS VARCHAR)
           || 's, resets later'
         WHEN event_id % 3 = 1 THEN 'rate limit reached' ELSE 'timeout' END AS error
  FROM events WHERE event_type = 'error'),
flagged AS (
  SELECT *, coalesce(regexp_matches(error, '(?i)rate limit'), false) AS rate_limited FROM errs)
SELECT event_id, label, attempt, rate_limited,
  CASE WHEN rate_limited AND attempt < 3 THEN 'retry' ELSE 'fail' END AS action,
  CASE WHEN rate_limited AND attempt < 3 THEN coalesce(TRY_CAST(nullif(regexp_extract(error,
    '(?i)retry after (\\d+)\\s*s', 1), '') AS DOUBLE), 60.0) + 2.0 END AS wait_sec
FROM flagged"""

# flagship -------------------------------------------------------------------------
SQL["flagship"] = with_ctes(ENRICH_DEPS, merged_cte("collapse")) + """
SELECT source_name, CAST(rank AS INTEGER) AS rank, doc_id, article_url, title_en, tag, overall_score,
  relevance_score FROM (
  SELECT *, row_number() OVER (PARTITION BY source_name
    ORDER BY overall_score DESC, relevance_score DESC, doc_id) AS rank
  FROM merged WHERE overall_score IS NOT NULL) WHERE rank <= 3"""



SQL["stream_ingest"] = with_ctes(ENRICH_DEPS, merged_cte("collapse") + ",\n" + STORE_ROWS) + """
SELECT hash_code, status, NULL AS reject_reason FROM store_rows
UNION ALL
SELECT hash_code, NULL, reject_reason FROM store_rows_all WHERE reject_reason IS NOT NULL
UNION ALL
SELECT hash_code, NULL, 'duplicate_hash' FROM ranked WHERE NOT kept"""
SQL["stream_syncback"] = with_ctes(["pull", "review_store"], PULLED) + """
SELECT s.unique_id, coalesce(d.new_status, s.status) AS status
FROM review_store s LEFT JOIN diffs d USING (unique_id)"""


def _run_half(half: int) -> str:
    """Hashes of the fetched links of one half (CTEs named with the half)."""
    sql = (JOINED.replace("FROM links l JOIN sources s USING (source_id)",
                          f"FROM links l JOIN sources s USING (source_id) WHERE pos % 2 = {half}")
           + ",\n" + LIMITED + ",\n" + DISCOVERED)
    for name in ("joined", "limited", "discovered", "fallback_links"):
        sql = sql.replace(f"{name} AS (", f"{name}{half} AS (").replace(f"FROM {name}", f"FROM {name}{half}")
    return sql + f""",
fetched{half} AS (
  SELECT DISTINCT {url_hash('f.url')} AS hash_code FROM fallback_links{half} f JOIN pages p ON p.url = f.url
  WHERE length({_html_sql('p.html')}) > 0)"""


SQL["ingest_two_runs"] = with_ctes(["sources", "links", "responses"], _run_half(0) + ",\n" + _run_half(1)
                                   + ",\n" + """stored AS (
  SELECT hash_code, '20260101_000000' AS run_id FROM fetched0
  UNION ALL
  SELECT hash_code, '20260102_000000' FROM fetched1 WHERE hash_code NOT IN (SELECT hash_code FROM fetched0))""") + """
SELECT hash_code, run_id, CAST(NULL AS INTEGER) AS overall_score FROM stored"""

SQL["ingest_duplicate_bodies"] = with_ctes(["sources", "links"], JOINED) + f"""
, rows_ AS (
  SELECT j.source_id, j.pos, j.url AS article_url, {url_hash('j.url')} AS hash_code, {_html_sql('p.html')} AS markdown
  FROM joined j JOIN pages p ON p.url = j.url)
SELECT hash_code, source_id, pos, article_url, sha256(markdown) AS markdown_sha FROM rows_
WHERE length(markdown) > 0
QUALIFY row_number() OVER (PARTITION BY hash_code ORDER BY source_id, pos, article_url) = 1"""

SQL["flagship_links"] = with_ctes(
    ["sources", "links", "store", "dec_sc"], JOINED + ",\n" + LIMITED + ",\n" + DISCOVERED) + f"""
SELECT source_id, CAST(rank AS INTEGER) AS rank, pos, url, hash_code, overall_score, relevance_score,
  quality_score FROM (
  SELECT f.source_id, f.pos, f.url, f.hash_code, s.sc_overall_score AS overall_score,
    s.sc_relevance_score AS relevance_score, s.sc_quality_score AS quality_score,
    row_number() OVER (PARTITION BY f.source_id ORDER BY s.sc_overall_score DESC,
                       s.sc_relevance_score DESC, f.pos) AS rank
  FROM (SELECT *, {url_hash('url')} AS hash_code FROM fallback_links) f
  JOIN links l2 ON {url_hash('l2.url')} = f.hash_code JOIN dec_sc s ON s.doc_id = l2.pos
  WHERE f.hash_code NOT IN (SELECT hash_code FROM store) AND s.sc_err IS NULL)
WHERE rank <= 3"""

STATUS = """status AS (
  SELECT source_id, 'default' AS mode, length(name) % 7 <> 0 AS ok FROM sources
  UNION ALL
  SELECT source_id, 'sitemap' AS mode, length(name) % 5 <> 0 AS ok FROM sources),
links_ok AS (
  SELECT l.* FROM links l
  WHERE EXISTS (SELECT 1 FROM status s WHERE s.source_id = l.source_id AND s.mode = l.mode AND s.ok)
    AND EXISTS (SELECT 1 FROM status s WHERE s.source_id = l.source_id AND s.mode = 'default' AND s.ok))"""

SQL["discover_with_status"] = with_ctes(["sources", "links"], STATUS + ",\n" + JOINED.replace(
    "FROM links l", "FROM links_ok l") + ",\n" + LIMITED + ",\n" + DISCOVERED) + \
    f"SELECT {LINK_COLS} FROM fallback_links"

SQL["discover_counts_status"] = with_ctes(["sources", "links"], STATUS + ",\n" + JOINED + ",\n"
                                          + LIMITED) + f"""
, per AS (
  SELECT source_id,
    CAST(count_if(mode = 'default') AS BIGINT) AS d_disc,
    CAST(count_if(mode = 'default' AND {KEEP}) AS BIGINT) AS d_kept,
    CAST(count_if(mode = 'sitemap') AS BIGINT) AS s_disc,
    CAST(count_if(mode = 'sitemap' AND {KEEP}) AS BIGINT) AS s_kept
  FROM limited GROUP BY source_id),
src AS (
  SELECT s.source_id, s.name, NOT EXISTS (SELECT 1 FROM status t WHERE t.source_id = s.source_id
    AND t.mode = 'sitemap' AND NOT t.ok) AS sitemap_ok
  FROM sources s WHERE EXISTS (SELECT 1 FROM status t WHERE t.source_id = s.source_id
    AND t.mode = 'default' AND t.ok))
SELECT s.source_id, s.name, coalesce(d_kept, 0) = 0 AND sitemap_ok AS used_fallback,
  CAST(CASE WHEN coalesce(d_kept, 0) = 0 AND sitemap_ok THEN coalesce(s_disc, 0)
       ELSE coalesce(d_disc, 0) END AS BIGINT) AS discovered,
  CAST(CASE WHEN coalesce(d_kept, 0) = 0 AND sitemap_ok THEN coalesce(s_kept, 0)
       ELSE coalesce(d_kept, 0) END AS BIGINT) AS kept
FROM src s LEFT JOIN per USING (source_id)"""


SQL["run_counters"] = with_ctes(["sources", "links", "pull", "review_store"], PULLED + ",\n" + _run_half(0) + ",\n"
                                + _run_half(1)) + f"""
, rows_ AS (
  SELECT 0 AS half, {url_hash('f.url')} AS h FROM fallback_links0 f JOIN (SELECT url, length({_html_sql('arg_max(html, length(html))')}) AS n
    FROM pages GROUP BY url) p ON p.url = f.url WHERE n > 0
  UNION ALL
  SELECT 1, {url_hash('f.url')} FROM fallback_links1 f JOIN (SELECT url, length({_html_sql('arg_max(html, length(html))')}) AS n
    FROM pages GROUP BY url) p ON p.url = f.url WHERE n > 0),
counts AS (
  SELECT half, count(*) AS total, count_if(half = 1 AND h IN (SELECT hash_code FROM fetched0)) AS skipped
  FROM (SELECT 0 AS half, NULL AS h WHERE false UNION ALL SELECT * FROM rows_) GROUP BY half),
every AS (SELECT h.half, coalesce(c.total, 0) AS total, coalesce(c.skipped, 0) AS skipped
          FROM (VALUES (0), (1)) h(half) LEFT JOIN counts c USING (half))
SELECT 'run' || half AS step, u.counter, CAST(u.value AS BIGINT) AS value FROM every,
  LATERAL (VALUES ('total', total), ('skipped', skipped), ('new', total - skipped), ('scraped_rows', total)) u(counter, value)
UNION ALL SELECT 'sync', 'applied', count(*) FROM diffs
UNION ALL SELECT 'sync', 'total', count(*) FROM diffs
UNION ALL SELECT 'sync', 'rejected', count(*) FROM checked WHERE reject_reason IS NOT NULL"""

SQL["model_rounds"] = """
WITH d AS (SELECT doc_id, doc_id % 7 AS kind, doc_id % 11 + 2.0 AS hint FROM documents)
SELECT doc_id, CASE WHEN kind NOT IN (4, 5) THEN 'answer ' || CASE WHEN kind IN (1, 2, 3) THEN kind ELSE 0 END END AS response,
  CASE kind WHEN 4 THEN 'rate limit' WHEN 5 THEN 'bad request' END AS error,
  CAST(CASE WHEN kind IN (1, 2, 3) THEN kind + 1 WHEN kind = 4 THEN 4 ELSE 1 END AS INTEGER) AS attempts,
  CAST(CASE WHEN kind IN (1, 2, 3) THEN kind * hint WHEN kind = 4 THEN 3 * 62 ELSE 0 END AS DOUBLE) AS waited_sec,
  CASE kind WHEN 4 THEN 'retries_used_up' WHEN 5 THEN 'not_retryable' END AS reason
FROM d"""

SQL["semantic_classes"] = """
WITH RECURSIVE b AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
v AS (
  SELECT vec_id, e FROM b
  UNION ALL SELECT vec_id + 1000000, list_transform(e, lambda x, i: CASE WHEN (i - 1 + vec_id) % 12 < 1 THEN 0.0 ELSE x * 1.5 END)
    FROM b WHERE vec_id % 5 = 0
  UNION ALL SELECT vec_id + 2000000, list_transform(e, lambda x, i: CASE WHEN (i - 1 + vec_id) % 12 < 2 THEN 0.0 ELSE x * 1.5 END)
    FROM b WHERE vec_id % 10 = 0
  UNION ALL SELECT vec_id + 3000000, e FROM b WHERE vec_id % 7 = 0),
l AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND list_cosine_similarity(p.e, q.e) >= 0.9),
r(id, seen) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, l.b FROM r JOIN l ON r.seen = l.a)
SELECT id AS vec_id, min(seen) AS class_id FROM r GROUP BY id"""


SQL["push_rejects"] = with_ctes(MIRROR_BASE, MIRROR_PRE) + """
SELECT hash_code, CASE WHEN substring(hash_code, 1, 1) IN ('0', '1') THEN 'missing_unique_id' END AS reject_reason FROM inc"""

SQL["source_dashboard"] = """
WITH c AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'S0' ELSE 'S' || (1 + user_id % 6) END AS source_id,
    event_id % 3 + event_id % 2 AS run, event_type, value FROM events)
SELECT source_id, count(DISTINCT run) AS runs, count(*) AS calls, count_if(event_type = 'error') AS failures,
  max(value) AS slowest_sec, true AS urls_near, true AS p50_near, true AS p95_near
FROM c GROUP BY source_id"""

SQL["ready_feed"] = with_ctes(["review_store"], "x AS (SELECT 1)") + f"""
, s AS (SELECT unique_id, status AS s0, CASE WHEN CAST(unique_id AS BIGINT) % 2 = 0 THEN 'READY' ELSE 'DISCARD' END AS s1,
    CASE WHEN CAST(unique_id AS BIGINT) % 3 = 0 THEN 'READY' ELSE 'DISCARD' END AS s2 FROM review_store),
one AS (SELECT unique_id, '{SYNC_TS}' AS changed_at, s0 AS previous_status FROM s WHERE s1 = 'READY' AND s0 <> 'READY'),
two AS (SELECT unique_id, '2026-01-03T00:00:00' AS changed_at, s1 AS previous_status FROM s WHERE s2 = 'READY' AND s1 <> 'READY')
SELECT 'site' AS consumer, '1' AS reading, * FROM one
UNION ALL SELECT 'site', '2', * FROM two
UNION ALL SELECT 'site', '1', * FROM one
UNION ALL SELECT 'mail', '1', * FROM one
UNION ALL SELECT 'mail', '1', * FROM two"""

SQL["archive_move"] = with_ctes(["pull", "review_store"], PULLED) + """
, now AS (SELECT s.unique_id, coalesce(d.new_status, s.status) AS status
  FROM review_store s LEFT JOIN diffs d USING (unique_id))
SELECT phase, status, count(*) AS n, count(DISTINCT unique_id) AS n_ids
FROM now, (VALUES ('before'), ('copied'), ('committed'), ('cleaned')) p(phase) GROUP BY phase, status
UNION ALL SELECT 'live', NULL, count_if(status NOT IN ('PUBLISHED', 'DISCARD')), count_if(status NOT IN ('PUBLISHED', 'DISCARD')) FROM now"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
