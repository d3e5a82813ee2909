"""Token usage of one model call from its JSON usage record.

Precedence: ``token_usage`` then ``usage``; in each, input =
prompt_tokens | input_tokens, output = completion_tokens | output_tokens,
total = total_tokens | input+output, where a zero counts as absent; the
first block with any non-zero count wins. Otherwise the counts are summed
over the generations (a list, or a list of lists) by ``usage_metadata`` or
``message.usage_metadata`` (total = its sum, or input+output).

The record is parsed once to VARIANT; the candidate counts are extracted in
one projection and combined in the next, so each generated expression stays
small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = ("token_usage", "usage")
# Key names per count, in precedence order.
KEYS = {"in": ("prompt_tokens", "input_tokens"), "out": ("completion_tokens", "output_tokens"),
        "tot": ("total_tokens",)}


def _num(v: str, path: str) -> Column:
    # falsy (absent, null, 0, non-number) -> 0
    return F.coalesce(F.expr(f"try_cast(try_variant_get({v}, '{path}', 'double') AS BIGINT)"),
                      F.lit(0).cast("bigint"))


def _gen_sum(v: str, key: str) -> Column:
    gens = (f"coalesce(flatten(try_variant_get({v}, '$.generations', 'array<array<variant>>')), "
            f"try_variant_get({v}, '$.generations', 'array<variant>'), array())")
    return F.expr(f"aggregate({gens}, 0L, (acc, g) -> acc + coalesce(try_cast(coalesce("
                  f"try_variant_get(g, '$.usage_metadata.{key}', 'double'), "
                  f"try_variant_get(g, '$.message.usage_metadata.{key}', 'double')) AS BIGINT), 0L))")


def _first_nonzero(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in cols], F.lit(0).cast("bigint"))


def add_usage_columns(df: DataFrame, usage_col: str = "usage") -> DataFrame:
    """Add input_tokens, output_tokens, total_tokens (bigint) from a JSON column."""
    v = "_usage_v"
    df = df.withColumn(v, F.expr(f"try_parse_json(`{usage_col}`)"))
    raw = {}
    for b in BLOCKS:
        raw[f"_{b}_obj"] = F.coalesce(
            F.expr(f"schema_of_variant(try_variant_get({v}, '$.{b}', 'variant'))").like("OBJECT%"),
            F.lit(False))
        for k, names in KEYS.items():
            for n in names:
                raw[f"_{b}_{n}"] = _num(v, f"$.{b}.{n}")
    for n in ("input_tokens", "output_tokens", "total_tokens"):
        raw[f"_gen_{n}"] = _gen_sum(v, n)
    df = df.withColumns(raw)
    mid = {}
    for b in BLOCKS:
        i = _first_nonzero(*[F.col(f"_{b}_{n}") for n in KEYS["in"]])
        o = _first_nonzero(*[F.col(f"_{b}_{n}") for n in KEYS["out"]])
        mid[f"_{b}_i"], mid[f"_{b}_o"] = i, o
    df = df.withColumns(mid)
    for b in BLOCKS:
        t = F.coalesce(F.nullif(F.col(f"_{b}_total_tokens"), F.lit(0)),
                       F.col(f"_{b}_i") + F.col(f"_{b}_o"))
        df = df.withColumn(f"_{b}_t", t)
    ok = {b: F.col(f"_{b}_obj") & ((F.col(f"_{b}_i") != 0) | (F.col(f"_{b}_o") != 0)
                                    | (F.col(f"_{b}_t") != 0)) for b in BLOCKS}
    gi, go, gt = F.col("_gen_input_tokens"), F.col("_gen_output_tokens"), F.col("_gen_total_tokens")
    out = {}
    for name, short, gen in (("input_tokens", "i", gi), ("output_tokens", "o", go),
                             ("total_tokens", "t", F.coalesce(F.nullif(gt, F.lit(0)), gi + go))):
        out[name] = (F.when(ok["token_usage"], F.col(f"_token_usage_{short}"))
                     .when(ok["usage"], F.col(f"_usage_{short}")).otherwise(gen))
    df = df.withColumns(out)
    return df.drop(v, *raw.keys(), *mid.keys(), *[f"_{b}_t" for b in BLOCKS])
