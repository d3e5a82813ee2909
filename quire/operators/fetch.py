"""Fetched bodies: kept links joined to page bodies, empty bodies dropped."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CurationConfig
from ..functions.html import html_to_text
from ..functions.markdown import to_markdown
from .rounds import ask_in_rounds


def _body(bodies: DataFrame) -> Column:
    """``markdown`` where a body has it, else ``html``; with the kind."""
    has = set(bodies.columns)
    none = F.lit(None).cast("string")
    markdown = F.col("markdown") if "markdown" in has else none
    html = F.col("html") if "html" in has else none
    return F.struct(F.length(F.coalesce(markdown, html)).alias("n"), F.coalesce(markdown, html).alias("body"),
                    markdown.isNull().alias("is_html"))


def one_body(bodies: DataFrame, urls: DataFrame) -> DataFrame:
    """``url, body, is_html``: one body for each of ``urls`` that has any.

    A URL fetched several times keeps its longest body (of equally long ones
    the last in text order). Only bodies that were asked for are compared.
    """
    asked = bodies.join(urls.select("url").distinct(), "url", "left_semi")
    best = asked.groupBy("url").agg(F.max(_body(bodies)).alias("b"))
    return best.select("url", "b.body", "b.is_html")


def scrape_join(kept: DataFrame, bodies: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per kept link; a link without a fetched body has NULL markdown.
    ``also``: further columns of the links to keep.

    ``bodies``: url with ``html``, ``markdown`` or both. The narrow link side is
    joined on the URL first; the HTML-to-text regex chain runs only on bodies
    that were asked for.
    """
    b = one_body(bodies, kept).withColumnRenamed("url", "article_url")
    j = kept.select("source_id", "pos", "source_name", "source_url",
                    F.col("url").alias("article_url"), *also).join(b, "article_url", "left")
    text = F.when(F.col("is_html"), html_to_text(F.col("body"))).otherwise(F.col("body"))
    return j.select("source_id", "pos", "source_name", "source_url", "article_url",
                    text.alias("markdown"), *also)


def fetch_bodies(kept: DataFrame, fn: Callable[[str], str | None], partitions: int | None = None) -> DataFrame:
    """``url, markdown, error`` of each different kept URL, from a user callable.

    A URL whose call raises has a null body and the error; the others go on.
    ``partitions`` caps how many calls run at once.
    """
    urls = kept.select("url").where("url is not null").distinct()
    urls = urls.repartition(partitions) if partitions else urls

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            got = []
            for url in pdf["url"]:
                try:
                    got.append((fn(url), None))
                except Exception as exc:  # noqa: BLE001 - one page must not end the run
                    got.append((None, f"{type(exc).__name__}: {exc}"))
            yield pdf.assign(markdown=[g[0] for g in got], error=[g[1] for g in got])

    return urls.mapInPandas(run, "url string, markdown string, error string")


def fetch_in_rounds(kept: DataFrame, fn: Callable[[str], str | None], path: str, cfg: CurationConfig,
                    pause=time.sleep) -> DataFrame:
    """``fetch_bodies`` with rate-limited URLs asked again, as ``cfg`` has it: ``url, markdown,
    error, attempts, waited_sec``. Each round is written under ``path``."""
    urls = kept.select("url").where("url is not null").distinct()
    return ask_in_rounds(urls, lambda r: fetch_bodies(r, fn, cfg.model_partitions), ("url",), path, cfg.max_retries,
                         cfg.fallback_sleep_sec, cfg.extra_pad_sec, pause)


def drop_empty_body(scraped: DataFrame) -> DataFrame:
    """Drop NULL and zero-length bodies; whitespace-only bodies are kept."""
    return scraped.where(F.col("markdown").isNotNull() & (F.length("markdown") > 0))


def bodies_as_markdown(bodies: DataFrame, html_col: str = "html") -> DataFrame:
    """``bodies`` with ``markdown`` made of their HTML, in place of ``html_col``; a null page has none.

    Fetched pages in this form join the links like any other bodies (``scrape_join``).
    A task holds one page's blocks at a time.
    """
    rest = bodies.drop("markdown")
    at = rest.columns.index(html_col)
    fields = ", ".join(f"`{'markdown' if f.name == html_col else f.name}` {f.dataType.simpleString()}" for f in rest.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([to_markdown(x.as_py()) for x in batch.column(at)], pa.string())
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)],
                                             ["markdown" if i == at else n for i, n in enumerate(batch.schema.names)])

    return rest.mapInArrow(run, fields)


def page_text(pages: DataFrame) -> DataFrame:
    t = html_to_text(F.col("html"))
    return pages.select("page_id", t.alias("text")).withColumn("n_chars", F.length("text"))
