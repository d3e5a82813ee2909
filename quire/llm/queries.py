"""Queries of the training-data operators: ``fn(spark, sf_dir) -> DataFrame``.

Each applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontaminate, line_dedup, lm_score, packing, periodic_runs, quality, secrets, simhash
from . import surrogates, token_counts, url_rules, whitening
from .common import table
from .oracle import ORACLE_SQL  # noqa: F401

#: Keys the surrogates of the query; a deployment passes its own secret.
SURROGATE_KEY = "quire-query"


def op1_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(table(spark, d, "documents", "doc_id", "source", "text"))


def op2_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, d, "documents", "doc_id", "text"))


def op2_trigram_scoring(spark: SparkSession, d: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, d, "documents", "doc_id", "text"), order=3)


def op3_url_filters(spark: SparkSession, d: str) -> DataFrame:
    """A page is labelled by the label of its number: bad is low quality or toxic."""
    pages = table(spark, d, "pages", "page_id", "url")
    labels = table(spark, d, "labels", "doc_id", "quality", "toxic")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    labelled = pages.join(labels, pages["page_id"] == labels["doc_id"]).select("url", bad)
    return url_rules.judge_urls(pages, labelled)


def op4_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op5_secret_scans(spark: SparkSession, d: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, d, "documents", "doc_id", "text"))


def op6_pii_surrogates(spark: SparkSession, d: str) -> DataFrame:
    return surrogates.replace_pii(table(spark, d, "documents", "doc_id", "text"), SURROGATE_KEY)


def op7_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, d, "documents", "doc_id", "text"))


def op8_token_counts(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = token_counts.piece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, d, "documents", "doc_id", "text"), vocabulary)


def op9_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, d, "documents", "doc_id", "text"))


def op9_passage_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.dedup_passages(table(spark, d, "documents", "doc_id", "text"))


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, d, "documents", "doc_id", "text"),
                                    table(spark, d, "benchmark", "item_id", "text"))


def op11_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    docs = periodic_runs.with_planted_period(table(spark, d, "documents", "doc_id", "text"))
    found = periodic_runs.find_runs(docs)
    best = periodic_runs.best_run(F.col("runs"))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def op12_embedding_whitening(spark: SparkSession, d: str) -> DataFrame:
    rows = whitening.whiten(table(spark, d, "embeddings", "vec_id", "embedding"))
    return (rows.select("vec_id", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), "explained",
                        "identity_error", F.posexplode("whitened").alias("pos", "whitened"))
            .select("vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", "whitened",
                    F.get("explained", F.col("pos")).alias("explained"), "identity_error"))


def op13_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = byte_bpe.encode(table(spark, d, "documents", "doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(ids, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_lm_scoring, op2_trigram_scoring, op3_url_filters, op4_packing, op5_secret_scans,
        op6_pii_surrogates, op7_simhash, op8_token_counts, op9_line_dedup, op9_passage_dedup, op10_decontamination,
        op11_periodic_runs, op12_embedding_whitening, op13_byte_bpe)}
