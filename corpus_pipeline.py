"""Corpus pipeline: documents to packed training sequences.

Each stage is ``fn(spark, docs, sf_dir) -> DataFrame`` and calls one operator of
``quire.llm``. All but the last return the columns of ``documents``; what a
stage returns is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, line_dedup, packing, quality, simhash
from quire.llm.common import table
from quire.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules on a host that isn't rejected."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of line runs are deleted; documents of which nothing is left go.

    ``n_chars`` follows the text.
    """
    out = line_dedup.drop_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that of the least id."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packed),
]

#: Tokens, edit distances and fingerprints have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is kept in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
