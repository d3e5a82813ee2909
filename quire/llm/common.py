"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: ASCII white space: the separators of ``[^\\x20\\x09-\\x0D]+`` words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again.

    Unlike a checkpoint it is compressed and pruned by column, and the planner
    knows its size. The folder's owner removes it.
    """
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    The optimizer may copy a projected column into each of its uses; a lambda
    variable is never copied.
    """
    return F.transform(F.array(value), body)[0]


def whole_text(col: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """``[^\\x20\\x09-\\x0D]+`` words of a text, in order."""
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def hex64(value: Column) -> Column:
    """A long as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
