"""Tables partitioned by a prefix of their key, read only where a batch has keys.

A table that grows with every run (stored hashes, answers) is laid out by the
first digits of its hash key. A batch's prefixes are found when the query runs;
the scan then lists only their partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = "prefix"  #: the partition column
PREFIX_DIGITS = 2  #: hexadecimal digits, so at most 256 partitions


def prefix_of(key: str) -> Column:
    return F.substring(F.col(key), 1, PREFIX_DIGITS)


def narrowed(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``table`` whose ``key`` is among those of ``keys``, once each.

    With a ``prefix`` column only the partitions of the batch's prefixes are
    read: a scalar subquery gathers them (256 values at most), and the scan
    prunes by it. Rows without a prefix are read always. What is left is
    semi-joined: by a broadcast of the batch's keys if they are small, else
    shuffled on the key, and no more of the table than that.
    """
    mine = keys.select(key).where(F.col(key).isNotNull()).distinct()
    if PREFIX in table.columns:
        met = mine.agg(F.collect_set(prefix_of(key))).scalar()
        table = table.where(F.col(PREFIX).isNull() | F.array_contains(met, F.col(PREFIX)))
    return table.join(mine, key, "left_semi")
