"""DuckDB SQL for the queries that SQL can express."""

OP1 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
      FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w)),
r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid),
l AS (SELECT rid, count(*) - count(DISTINCT line) AS n
      FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_replace(line, '[\x20\x09-\x0D]', '', 'g') <> '' GROUP BY rid),
m AS (SELECT d.doc_id, d.host, len(w.ws)::BIGINT AS n_words,
        length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (rid) LEFT JOIN c USING (rid) LEFT JOIN l USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT host, count(*)::DOUBLE AS n, count(*) FILTER (WHERE base_failed)::DOUBLE AS k FROM f GROUP BY host),
s AS (SELECT sum(n) AS n, sum(k) / sum(n) AS p, count(*) AS hosts, sum(n * n) AS nn, sum(k * k / n) AS kk FROM h),
b AS (SELECT p, p * (1 - p) AS within, n - nn / n AS spare,
        (kk - n * p * p - (hosts - 1) * p * (1 - p)) / nullif(n - nn / n, 0) AS between_ FROM s),
z AS (SELECT p, CASE WHEN spare > 0 AND within > 0 AND between_ > 0
        THEN least(1000.0, greatest(5.0, within / between_ - 1)) ELSE 1000.0 END AS strength FROM b),
v AS (SELECT host, (k + strength * p) / (n + strength) AS rate FROM h, z)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND v.rate <= 0.6 AS kept, f.host, round(v.rate, 6) AS host_rate
FROM f JOIN v ON f.host IS NOT DISTINCT FROM v.host
"""

OP2 = r"""
WITH d AS (
  SELECT doc_id, coalesce((strpos('0123456789abcdef', substr(md5(doc_id::VARCHAR), 1, 1)) - 1) % 2, 0) AS fold,
    list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws
  FROM documents),
t AS (SELECT doc_id, fold, i, ws[i] AS w, CASE WHEN i = 1 THEN '<s>' ELSE ws[i - 1] END AS v
      FROM (SELECT doc_id, fold, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
u AS (SELECT w, count(*) FILTER (WHERE fold = 0) AS c0, count(*) FILTER (WHERE fold = 1) AS c1
      FROM (SELECT w, fold FROM t UNION ALL SELECT '<s>', fold FROM d) GROUP BY w),
p AS (SELECT v, w, count(*) FILTER (WHERE fold = 0) AS c0, count(*) FILTER (WHERE fold = 1) AS c1
      FROM t GROUP BY v, w),
n AS (SELECT count(*) FILTER (WHERE fold = 0) AS n0, count(*) FILTER (WHERE fold = 1) AS n1 FROM t),
x AS (SELECT t.doc_id, CASE WHEN t.fold = 0 THEN p.c1 ELSE p.c0 END AS pair,
        greatest(CASE WHEN t.fold = 0 THEN uv.c1 ELSE uv.c0 END, 1) AS cv,
        greatest(CASE WHEN t.fold = 0 THEN uw.c1 ELSE uw.c0 END, 1) AS cw,
        greatest(CASE WHEN t.fold = 0 THEN n.n1 ELSE n.n0 END, 1) AS total
      FROM t JOIN p USING (v, w) JOIN u uv ON uv.w = t.v JOIN u uw ON uw.w = t.w, n),
y AS (SELECT doc_id, pair > 0 AS seen, CASE WHEN pair > 0
        THEN round(ln(pair) * 1000000)::BIGINT - round(ln(cv) * 1000000)::BIGINT
        ELSE round(ln(0.4) * 1000000)::BIGINT + round(ln(cw) * 1000000)::BIGINT
             - round(ln(total) * 1000000)::BIGINT END AS score FROM x),
z AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE seen) AS n_seen, sum(score)::BIGINT AS score
      FROM y GROUP BY doc_id)
SELECT d.doc_id, coalesce(z.n, 0) AS n_words, coalesce(z.n_seen, 0) AS n_seen,
  coalesce(z.score, 0) AS score_micro, round(z.score / 1000000.0::DOUBLE / z.n, 6) AS mean_logprob
FROM (SELECT DISTINCT doc_id FROM d) d LEFT JOIN z ON d.doc_id IS NOT DISTINCT FROM z.doc_id
"""

OP9 = r"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i - 1 AS line, ls[i] AS s FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
e AS (SELECT doc_id, line, md5(s) || ':' || j AS h, j
      FROM (SELECT doc_id, line, s, unnest(range(1, ((length(s) + 99) // 100) + 1)) AS j FROM l
            WHERE regexp_replace(s, '[\x20\x09-\x0D]', '', 'g') <> '')),
q AS (SELECT doc_id, row_number() OVER o AS pos, h || ' ' || lead(h, 1) OVER o || ' ' || lead(h, 2) OVER o AS run,
        line AS first_line, lead(line, 2) OVER o AS last_line
      FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY line, j)),
k AS (SELECT doc_id, first_line, last_line FROM q WHERE run IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1),
x AS (SELECT DISTINCT doc_id, unnest(range(first_line, last_line + 1)) AS line FROM k),
n AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id),
r AS (SELECT doc_id, string_agg(s, chr(10) ORDER BY line) AS s FROM l ANTI JOIN x USING (doc_id, line) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n.n IS NULL THEN d.text ELSE coalesce(r.s, '') END AS text,
  coalesce(n.n, 0)::INTEGER AS n_removed
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id)
"""

ORACLE_SQL = {"op1_quality_rules": OP1, "op2_lm_scoring": OP2, "op9_line_dedup": OP9}
