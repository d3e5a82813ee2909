"""Fixtures of the training-data tests; test modules import them by name."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

SYLLABLES = "ka lo mi ne ru sa to vi be da".split()

#: Texts that every operator must take.
ODD = [None, "", " \t\n\x0b\x0c\r ", "a", "\n\n\n", "é ü ñ", "日本語 текст", "x " * 50_000, "y" * 200_000, "same\nsame\nsame\nsame"]


@pytest.fixture()
def make_docs(spark):
    """make_docs([(doc_id, text), ...]) in the columns of documents; a third value is the source."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture()
def prose():
    """prose(seed, n): n invented words in lines."""
    def write(seed, n, per_line=8):
        rng = random.Random(seed)
        words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
        return "\n".join(" ".join(words[i: i + per_line]) for i in range(0, n, per_line))
    return write


@pytest.fixture()
def odd_docs(make_docs):
    """Odd texts, one repeated row, and rows without an id."""
    rows = list(enumerate(ODD))
    return make_docs([*rows, rows[5], (None, "no id at all"), (None, None)])


@pytest.fixture()
def clashing():
    """Adds columns with names that operators use or return."""
    names = ("n_words", "fp", "host", "key", "hash", "count", "sequence_id", "n_removed", "n_entities", "kept", "run", "p")

    def add(df):
        return df.withColumns({n: F.lit("clash") for n in names})
    return add
