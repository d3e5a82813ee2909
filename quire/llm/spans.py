"""Positions of pattern matches in a text, by built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import let

BLOCK = 128
_LONGS = "array<bigint>"


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of longs.

    In blocks, so that an array of n values takes about n * BLOCK copies
    instead of n * n.
    """

    def scan(part: Column) -> Column:
        return F.aggregate(part, F.array().cast(_LONGS), lambda acc, x: F.array_append(
            acc, F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x).cast(_LONGS))

    def of(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(v), F.lit(BLOCK))
        return let(F.transform(starts, lambda s: scan(F.slice(v, s, BLOCK))), joined)

    def joined(blocks: Column) -> Column:
        return let(scan(F.transform(blocks, lambda b: F.element_at(b, -1))), lambda ends: F.flatten(F.transform(
            blocks, lambda b, i: F.transform(b, lambda x: x + F.coalesce(F.get(ends, i - 1), F.lit(0))))))

    return let(values.cast(_LONGS), lambda v: F.when(F.size(v) == 0, v).otherwise(of(v)))


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, match>> of the leftmost non-overlapping matches.

    Positions in code points, end exclusive; ``match`` is the given group. The
    pattern matches no empty string. A text without a match is read once.
    """

    def of(found: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        ends = running_sums(F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, whole:
                                       (F.char_length(gap) + F.char_length(whole)).cast("long")))
        return F.zip_with(F.zip_with(ends, found, lambda end, whole: F.struct(
            (end - F.char_length(whole)).alias("start"), end.alias("end"))),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found,
            lambda s, part: F.struct(s["start"].alias("start"), s["end"].alias("end"), part.alias("match")))

    none = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    return F.when(text.rlike(pattern), let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)).otherwise(none)
