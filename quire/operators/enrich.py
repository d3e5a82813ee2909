"""Model enrichment: request building, answer decoding, state merge.

The four model stages run in the order extract -> score -> generate_tag ->
review. Each stage is request builder (native) -> model answers (a table of
responses, or a user callable run with ``mapInPandas``) -> lax decode
(native, see ``functions.decode``) -> merge into the article state.

The answers of all stages are gathered to one row per key and joined to the
articles once.

A failed stage contributes none of its fields and appends ``{node, error}``
to ``stage_errors``. In ``collapse`` mode (what the original code does) a
failed extract makes the tag stage fail outside its own error handling, so
the article keeps only its initial state and one ``ainvoke`` error; in
``accumulate`` mode every stage error is kept and the review still runs.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import NODES, TAGS, CurationConfig
from ..functions import decode as dec
from ..schemas import EXTRACT_FIELDS, RESPONSES
from .prefixes import narrowed
from .rounds import ask_in_rounds

# User-message layouts of the four model calls.
EXTRACT_PROMPT = ("<SOURCE_URL>{article_url}</SOURCE_URL>\n"
                  "<SOURCE_NAME>{source_name}</SOURCE_NAME>\n"
                  "<SCRAPED_AT>{scraped_at}</SCRAPED_AT>\n\n"
                  "<ARTICLE_MARKDOWN>\n{raw_markdown}\n</ARTICLE_MARKDOWN>")
SCORE_PROMPT = ("<SOURCE_URL>{article_url}</SOURCE_URL>\n\n"
                "<ARTICLE_MARKDOWN>\n{raw_markdown}\n</ARTICLE_MARKDOWN>")
TAG_PROMPT = "<EXCERPT_EN>{excerpt_en}</EXCERPT_EN>"
REVIEW_PROMPT = ("<SOURCE_URL>{article_url}</SOURCE_URL>\n\n"
                 "<ARTICLE_MARKDOWN>\n{raw_markdown}\n</ARTICLE_MARKDOWN>\n\n"
                 "<EXTRACTED_FIELDS>\n"
                 "title_zh: {title_zh}\ntitle_en: {title_en}\nexcerpt_zh: {excerpt_zh}\n"
                 "excerpt_en: {excerpt_en}\nauthor: {author}\ncountry: {country}\n"
                 "published_at: {published_at}\nread_minutes: {read_minutes}\nnotes: {notes}"
                 "\n</EXTRACTED_FIELDS>")

# What the model is told before each message. Own wording; a run may pass others.
SCORE_RUBRIC = (
    "Relevance, 0 to 10: 9-10 speaks directly to the readers' decisions, 6-8 is useful background, "
    "3-5 touches the subject, 0-2 is off topic. Quality, 0 to 10: 9-10 is first-hand, sourced and clear, "
    "6-8 is sound with gaps, 3-5 is thin or one-sided, 0-2 is promotional, broken or unreadable.")
SYSTEM_PROMPTS = {
    "extract": ("You read one web article in Markdown and return its facts as one JSON object with the keys "
                "title_zh, title_en, excerpt_zh, excerpt_en, author, country, published_at, read_minutes and "
                "notes. Translate titles and excerpts where one language is missing. Use only what the article "
                "says; leave unknown text fields empty. published_at is an ISO date; read_minutes is a whole number."),
    "score": ("You judge one web article for an editorial team. " + SCORE_RUBRIC + " Return one JSON object with "
              "the whole numbers relevance_score and quality_score, and reason in one or two sentences."),
    "generate_tag": ("You file an article under exactly one tag by its excerpt: " + ", ".join(TAGS) + ". Return one "
                     "JSON object with tag and tag_reason."),
    "review": ("You check extracted fields against the article they came from. Correct what is wrong, keep what is "
               "right, and return one JSON object with all the fields, needs_revision (true if you changed any) and "
               "review_notes."),
}

# The error text of the collapse path.
COLLAPSE_NODE = "ainvoke"
COLLAPSE_ERROR = "'excerpt_en'"

PREFIX = {"extract": "ex", "score": "sc", "generate_tag": "tg", "review": "rv"}
FIELDS = {
    "extract": [(f, "int" if f == "read_minutes" else "str") for f in EXTRACT_FIELDS],
    "score": [("relevance_score", "score"), ("quality_score", "score"), ("reason", "str")],
    "generate_tag": [("tag", "tag"), ("tag_reason", "str")],
    "review": [(f, "int" if f == "read_minutes" else "str") for f in EXTRACT_FIELDS]
    + [("needs_revision", "bool"), ("review_notes", "str")],
}


def render(template: str, cols: dict[str, Column]) -> Column:
    """Fill ``{name}`` slots with columns (concat; a NULL slot gives NULL)."""
    parts: list[Column] = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(cols[piece].cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


# requests ----------------------------------------------------------------------
def system_message(node: Column, prompts: dict[str, str] | None = None) -> Column:
    """What the model is told before a node's message."""
    told = SYSTEM_PROMPTS | (prompts or {})
    out = F.lit(None).cast("string")
    for n in NODES:
        out = F.when(node == n, F.lit(told[n])).otherwise(out)
    return out


def extract_request(df: DataFrame) -> Column:
    return render(EXTRACT_PROMPT, {
        "article_url": F.col("article_url"),
        "source_name": F.coalesce(F.col("source_name"), F.lit("")),
        "scraped_at": F.coalesce(F.col("scraped_at"), F.lit("")),
        "raw_markdown": F.col("raw_markdown")})


def score_request(df: DataFrame) -> Column:
    return render(SCORE_PROMPT, {"article_url": F.col("article_url"),
                                 "raw_markdown": F.col("raw_markdown")})


def tag_request(excerpt_col: str = "ex_excerpt_en") -> Column:
    return render(TAG_PROMPT, {"excerpt_en": F.col(excerpt_col)})


def review_request(prefix: str = "ex") -> Column:
    cols = {f: F.coalesce(F.col(f"{prefix}_{f}").cast("string"),
                          F.lit("0" if f == "read_minutes" else ""))
            for f in EXTRACT_FIELDS}
    cols["article_url"] = F.col("article_url")
    cols["raw_markdown"] = F.col("raw_markdown")
    return render(REVIEW_PROMPT, cols)


# decode -----------------------------------------------------------------------
def decode_node(df: DataFrame, node: str, response: str = "response", error: str = "error",
                present: str | None = None) -> DataFrame:
    """Add ``<p>_<field>`` columns (NULL unless the whole answer is valid)
    and ``<p>_err`` (NULL when valid) for one stage's answer columns.

    Each step is its own projection and every intermediate is referenced by
    column, so the optimizer never copies one large expression into another.
    """
    p = PREFIX[node]
    v = f"_{p}_v"
    spec = FIELDS[node]
    names = [f for f, _ in spec]
    df = df.withColumn(v, dec.parse(f"`{response}`"))
    df = dec.field_columns(df, v, names, f"_{p}")
    raw = {f: f"_{p}_{f}_r" for f in names}
    df = df.withColumns({raw[f]: dec.raw_value(kind, f"_{p}_{f}_v", f"_{p}_{f}_k")
                         for f, kind in spec})
    errs = [dec.field_error(kind, f"_{p}_{f}_k", raw[f], f, TAGS) for f, kind in spec]
    missing = F.col(response).isNull()
    if present is not None:
        missing = missing | ~F.coalesce(F.col(present), F.lit(False))
    err = F.coalesce(F.col(error), F.when(missing, F.lit("missing_response")),
                     F.when(F.col(v).isNull(), F.lit("invalid_json")), *errs)
    df = df.withColumn(f"{p}_err", err)
    ok = F.col(f"{p}_err").isNull()
    df = df.withColumns({f"{p}_{f}": F.when(ok, F.col(raw[f])) for f in names})
    if node == "score":
        overall = F.bround((F.col("sc_relevance_score") + F.col("sc_quality_score")) / 2, 0)
        df = df.withColumn("sc_overall_score", overall.cast("int"))
    temp = [v] + [f"_{p}_{f}_{x}" for f in names for x in ("v", "k", "r")]
    return df.drop(*temp)


def decode_responses(responses: DataFrame, node: str, key: str = "doc_id") -> DataFrame:
    """One stage's answers decoded on the (narrow) responses table:
    key, <p>_<fields>, <p>_err, <p>_present."""
    p = PREFIX[node]
    r = responses.where(F.col("node") == node)
    x = decode_node(r, node)
    names = [f for f, _ in FIELDS[node]] + (["overall_score"] if node == "score" else [])
    return x.select(key, *[f"{p}_{f}" for f in names], f"{p}_err",
                    F.lit(True).alias(f"{p}_present"))


def decode_answers(responses: DataFrame, key: str = "doc_id", nodes=NODES) -> DataFrame:
    """All stages' answers of a key in one row: key, <p>_<fields>, <p>_err.

    The answers are read and shuffled once. Of several answers for one key and
    stage, one without an error wins, then the last in text order.
    """
    picked = [F.max(F.when(F.col("node") == n, F.struct(
        F.col("error").isNull().alias("ok"), "response", "error"))).alias(f"_{PREFIX[n]}_answer") for n in nodes]
    out = responses.where(F.col("node").isin(*nodes)).groupBy(key).agg(*picked)
    for n in nodes:
        p = PREFIX[n]
        out = out.withColumns({f"_{p}_response": F.col(f"_{p}_answer.response"),
                               f"_{p}_error": F.col(f"_{p}_answer.error")}).drop(f"_{p}_answer")
        out = decode_node(out, n, f"_{p}_response", f"_{p}_error").drop(f"_{p}_response", f"_{p}_error")
    return out


def attach_decoded(articles: DataFrame, responses: DataFrame, key: str = "doc_id",
                   nodes=NODES, keys: DataFrame | None = None) -> DataFrame:
    """Left-join the decoded answers to the articles; a stage without an answer
    gets ``missing_response``.

    Only answers of these articles are gathered and decoded: ``responses``, which
    hold what was ever asked, are narrowed to ``keys`` first (rows with the
    articles' key or more; the articles themselves by default).
    """
    mine = narrowed(responses, articles if keys is None else keys, key)
    decoded = decode_answers(mine, key, nodes).withColumn("_answered", F.lit(True))
    out = articles.join(decoded, key, "left")
    return out.withColumns({f"{PREFIX[n]}_err": F.when(F.col("_answered").isNull(), F.lit("missing_response"))
                            .otherwise(F.col(f"{PREFIX[n]}_err")) for n in nodes}).drop("_answered")


def valid_only(df: DataFrame, err_col: str) -> DataFrame:
    """Rows whose stage answer is valid.

    Kept through a generator rather than a filter: a filter on the error
    column would be pushed below the decode projections, where the optimizer
    substitutes the whole decode expression into the predicate and so parses
    every answer twice. A generator's output is not pushed through.
    """
    row = F.array(F.struct(*[F.col(c) for c in df.columns]))
    empty = F.array().cast(df.select(row).schema[0].dataType)
    return df.select(F.inline(F.when(F.col(err_col).isNull(), row).otherwise(empty)))


# merge ------------------------------------------------------------------------
def _err(node: str, msg: Column) -> Column:
    return F.struct(F.lit(node).alias("node"), msg.alias("error"))


def merge_state(df: DataFrame, mode: str = "collapse") -> DataFrame:
    """Final per-article state from decoded stage columns."""
    if mode not in ("collapse", "accumulate"):
        raise ValueError("on_missing_excerpt must be 'collapse' or 'accumulate'")
    ex_ok, sc_ok = F.col("ex_err").isNull(), F.col("sc_err").isNull()
    tg_ok, rv_ok = F.col("tg_err").isNull(), F.col("rv_err").isNull()
    collapsed = ~ex_ok if mode == "collapse" else F.lit(False)
    alive = ~collapsed
    # tag stage cannot run without the extract's excerpt
    tag_err = F.when(~ex_ok, F.lit("missing:excerpt_en")).otherwise(F.col("tg_err"))
    tag_ok = ex_ok & tg_ok
    out = {}
    for f in EXTRACT_FIELDS:
        out[f] = F.when(alive, F.when(rv_ok, F.col(f"rv_{f}")).otherwise(F.col(f"ex_{f}")))
    for f in ("relevance_score", "quality_score", "overall_score", "reason"):
        out[f] = F.when(alive & sc_ok, F.col(f"sc_{f}"))
    for f in ("tag", "tag_reason"):
        out[f] = F.when(alive & tag_ok, F.col(f"tg_{f}"))
    for f in ("needs_revision", "review_notes"):
        out[f] = F.when(alive & rv_ok, F.col(f"rv_{f}"))
    # node order; a stage without an error contributes nothing
    errs = F.array_compact(F.array(*[
        F.when(e.isNotNull(), _err(n, e)) for n, e in (
            ("extract", F.col("ex_err")), ("score", F.col("sc_err")),
            ("generate_tag", tag_err), ("review", F.col("rv_err")))]))
    collapse_errs = F.array(_err(COLLAPSE_NODE, F.lit(COLLAPSE_ERROR)))
    out["stage_errors"] = F.when(collapsed, collapse_errs).otherwise(errs) \
        .cast("array<struct<node:string,error:string>>")
    return df.withColumns(out)


def error_nodes(c: str = "stage_errors") -> Column:
    """Comma-joined node names of the stage errors ('?' for a missing name)."""
    return F.array_join(F.transform(F.col(c), lambda x: F.coalesce(x["node"], F.lit("?"))), ",")


def enrich(articles: DataFrame, responses: DataFrame, cfg: CurationConfig,
           key: str = "doc_id", keys: DataFrame | None = None) -> DataFrame:
    """Articles (with article_url, source_name, raw_markdown, scraped_at) ->
    articles with every model field and ``stage_errors``. ``keys``: as in ``attach_decoded``."""
    df = attach_decoded(articles, responses, key, keys=keys)
    df = merge_state(df, cfg.on_missing_excerpt)
    helper = [c for c in df.columns if c[:3] in ("ex_", "sc_", "tg_", "rv_")]
    return df.drop(*helper)


# pluggable model ----------------------------------------------------------------
# pandas DataFrame (doc_id, node, system, prompt, attempt) -> pandas DataFrame (doc_id, node, response,
# error and, where the model tells it, usage: a JSON record of its tokens), or a generator of such parts
ModelFn = Callable[["object"], "object"]
ANSWER_COLUMNS = ("doc_id", "node", "response", "error", "usage", "duration_sec", "started_at")


def call_model(fn: ModelFn, pdf):
    """``fn``'s answers for a batch, timed; each row stands for itself.

    ``fn`` may yield its answers in parts. If it raises, what it has yielded
    stays, and the rows without an answer are asked one by one; a row that raises
    by itself has no response and the error's name and text.
    """
    import pandas as pd

    def parts_of(part):
        out = fn(part)
        yield from [out] if isinstance(out, pd.DataFrame) else out

    def ask(part):
        """Answers, and what ended them early."""
        answers, began, failure = [], time.time(), None
        try:
            for out in parts_of(part):
                answers.append(out.reset_index(drop=True))
        except Exception as exc:  # noqa: BLE001 - one row must not end the run
            failure = f"{type(exc).__name__}: {exc}"
        if failure is not None and len(part) == 1 and not sum(map(len, answers)):
            failed = part[["doc_id", "node"]].assign(response=None, error=failure, usage=None, duration_sec=None,
                                                     started_at=pd.NaT)
            return failed[list(ANSWER_COLUMNS)], None
        out = pd.concat(answers, ignore_index=True) if answers else pd.DataFrame(columns=["doc_id", "node", "response", "error"])
        out["usage"] = out["usage"] if "usage" in out else None
        out["duration_sec"] = (time.time() - began) / max(1, len(out))
        out["started_at"] = pd.Timestamp(began, unit="s").floor("us")
        return out[list(ANSWER_COLUMNS)], failure

    out, failure = ask(pdf)
    if failure is None:
        return out
    answered = set(zip(out["doc_id"], out["node"]))
    open_rows = [i for i, k in enumerate(zip(pdf["doc_id"], pdf["node"])) if k not in answered]
    parts = [out, *(ask(pdf.iloc[i: i + 1])[0] for i in open_rows)]
    return pd.concat([x for x in parts if len(x)], ignore_index=True)


def infer(requests: DataFrame, fn: ModelFn, partitions: int | None = None,
          system_prompts: dict[str, str] | None = None) -> DataFrame:
    """Run a user model callable over (key, node, system, prompt, attempt) batches.

    ``fn`` gets a pandas DataFrame with columns doc_id, node, system, prompt and
    attempt (0 for the first call) and returns, or yields in parts, doc_id, node,
    response, error and optionally usage. The answers also carry duration_sec (a
    batch's time over its rows) and started_at. ``partitions`` caps how many
    calls run at once (one task per partition).
    """
    if partitions:
        requests = requests.repartition(partitions)
    if "attempt" not in requests.columns:
        requests = requests.withColumn("attempt", F.lit(0))

    def run(batches):
        for pdf in batches:
            yield call_model(fn, pdf)

    schema = T.StructType([requests.schema["doc_id"], *RESPONSES.fields[1:], T.StructField("usage", T.StringType()),
                           T.StructField("duration_sec", T.DoubleType()),
                           T.StructField("started_at", T.TimestampNTZType())])
    asked = requests.withColumn("system", system_message(F.col("node"), system_prompts))
    return asked.select("doc_id", "node", "system", "prompt", "attempt").mapInPandas(run, schema)


def model_attempts(answers: DataFrame) -> DataFrame:
    """``stage, duration_sec, usage, started_at`` of the model's answered calls.

    A call that was retried is one row: its last answer with the time it waited."""
    took = F.col("duration_sec")
    if "waited_sec" in answers.columns:
        took = took + F.col("waited_sec")
    return answers.where("duration_sec is not null").select(
        F.col("node").alias("stage"), took.alias("duration_sec"), "usage", "started_at")


BATCH_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _answers(spark, requests: DataFrame, fn, cfg: CurationConfig, path: str, pause) -> DataFrame:
    """The last model answers for ``requests``, each round written once under ``path``. A completed
    round (``_SUCCESS`` present) is reused when a run is restarted, so the
    model is not called again for it. The Arrow batch size is bounded while
    the rounds run (the setting is read when the job executes)."""
    old = spark.conf.get(BATCH_ROWS_CONF, None)
    spark.conf.set(BATCH_ROWS_CONF, str(cfg.model_batch_rows))
    try:
        return ask_in_rounds(requests, lambda r: infer(r, fn, cfg.model_partitions, cfg.system_prompts),
                             ("doc_id", "node"), path, cfg.model_retries, cfg.fallback_sleep_sec,
                             cfg.extra_pad_sec, pause)
    finally:
        if old is None:
            spark.conf.unset(BATCH_ROWS_CONF)
        else:
            spark.conf.set(BATCH_ROWS_CONF, old)


def enrich_with_model(articles: DataFrame, fn, cfg: CurationConfig, write_path: str, pause=time.sleep):
    """(enriched articles, the answers). Staged model calls with each stage's answers written once to
    ``write_path`` (a folder in the shared checkpoint dir), so a retried or
    re-evaluated plan never calls the model again for the same rows.

    Stage 1 asks extract and score (independent); stage 2 asks tag and
    review, which need the decoded extract. Rate-limited calls are asked again
    in up to ``cfg.model_retries`` rounds; ``rounds.dead_letters`` of the answers
    are those given up.
    """
    spark = articles.sparkSession
    base = articles.select("doc_id", "article_url", "source_name", "scraped_at", "raw_markdown")
    first = (base.select("doc_id", F.lit("extract").alias("node"),
                         extract_request(base).alias("prompt"))
             .unionByName(base.select("doc_id", F.lit("score").alias("node"),
                                      score_request(base).alias("prompt"))))
    r1 = _answers(spark, first, fn, cfg, f"{write_path}/stage1", pause)
    ex = attach_decoded(base, r1, nodes=("extract",))
    ok = valid_only(ex, "ex_err")
    tag_req = ok.select("doc_id", F.lit("generate_tag").alias("node"), tag_request().alias("prompt"))
    rv_src = ok if cfg.on_missing_excerpt == "collapse" else ex
    rv_req = rv_src.select("doc_id", F.lit("review").alias("node"), review_request().alias("prompt"))
    r2 = _answers(spark, tag_req.unionByName(rv_req), fn, cfg, f"{write_path}/stage2", pause)
    answers = r1.unionByName(r2)
    return enrich(articles, answers, cfg), answers
