"""Lax decoding of model responses (JSON text) into typed fields.

The model's structured output is validated leniently: an integer field takes
7, "7", " 7 ", 7.0, "7.0" and true; it rejects 7.5, "7.50", null and a
missing key. A text field takes only JSON strings. A boolean takes true,
"true", "yes", "0", 1 and rejects 2, "x", null.

Spark's typed ``from_json`` would turn "7" or 7.0 into NULL for an INT field,
so the response is parsed once to VARIANT (``try_parse_json``), which keeps
JSON types, and each field branches on ``schema_of_variant``. Everything is
a native expression.

Usage: ``field_columns`` adds, per field, the field's variant and its kind
as columns (so each is computed once per row); the ``lax_*`` helpers then
return ``(value, error)`` columns over them. ``error`` is NULL when the
field is valid, else a stable code: ``missing:<f>``, ``type:<f>``,
``range:<f>``, ``enum:<f>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INT_KINDS = "('BIGINT','INT','SMALLINT','TINYINT')"
# The strings the lax boolean rule accepts.
_TRUE_STRINGS = ("1", "on", "t", "true", "y", "yes")
_FALSE_STRINGS = ("0", "off", "f", "false", "n", "no")
_INT_TEXT = r"^\\s*[+-]?[0-9]+(\\.0+)?\\s*$"


def parse(c: str) -> Column:
    """VARIANT of a JSON text column; NULL for NULL or invalid JSON."""
    return F.expr(f"try_parse_json({c})")


def field_columns(df: DataFrame, v: str, fields, prefix: str) -> DataFrame:
    """Add ``<prefix>_<f>_v`` (the field as VARIANT, NULL if absent) and
    ``<prefix>_<f>_k`` (its JSON kind) for each field."""
    df = df.withColumns({f"{prefix}_{f}_v": F.expr(f"try_variant_get({v}, '$.{f}', 'variant')")
                         for f in fields})
    return df.withColumns({f"{prefix}_{f}_k": F.expr(f"schema_of_variant({prefix}_{f}_v)")
                           for f in fields})


def _get(fv: str, t: str) -> str:
    return f"try_variant_get({fv}, '$', '{t}')"


def raw_value(kind: str, fv: str, fk: str) -> Column:
    """The field converted under the lax rule for ``kind`` (str, int,
    score, bool, tag); NULL when it cannot be converted."""
    if kind in ("str", "tag"):
        return F.when(F.col(fk) == "STRING", F.expr(_get(fv, "string")))
    d = _get(fv, "double")
    if kind in ("int", "score"):
        s = _get(fv, "string")
        return F.expr(f"""try_cast(CASE
          WHEN {fk} IN {_INT_KINDS} THEN {_get(fv, 'bigint')}
          WHEN {fk} = 'BOOLEAN' THEN CASE WHEN {_get(fv, 'boolean')} THEN 1 ELSE 0 END
          WHEN ({fk} LIKE 'DECIMAL%' OR {fk} IN ('DOUBLE','FLOAT')) AND {d} = floor({d})
            THEN try_cast({d} AS BIGINT)
          WHEN {fk} = 'STRING' AND {s} RLIKE '{_INT_TEXT}'
            THEN try_cast(try_cast(trim({s}) AS DOUBLE) AS BIGINT)
        END AS INT)""")
    if kind == "bool":
        s = f"lower({_get(fv, 'string')})"
        t = ",".join(f"'{x}'" for x in _TRUE_STRINGS)
        fl = ",".join(f"'{x}'" for x in _FALSE_STRINGS)
        return F.expr(f"""CASE
          WHEN {fk} = 'BOOLEAN' THEN {_get(fv, 'boolean')}
          WHEN ({fk} IN {_INT_KINDS} OR {fk} LIKE 'DECIMAL%' OR {fk} IN ('DOUBLE','FLOAT'))
               AND {d} IN (0, 1) THEN {d} = 1
          WHEN {fk} = 'STRING' AND {s} IN ({t}) THEN true
          WHEN {fk} = 'STRING' AND {s} IN ({fl}) THEN false
        END""")
    raise ValueError(kind)


def field_error(kind: str, fk: str, raw: str, f: str, allowed=(), lo: int = 0,
                hi: int = 10) -> Column:
    """The error code of one field given its kind column and raw value."""
    k, r = F.col(fk), F.col(raw)
    e = F.when(k.isNull(), F.lit(f"missing:{f}")).when(r.isNull(), F.lit(f"type:{f}"))
    if kind == "score":
        e = e.when((r < lo) | (r > hi), F.lit(f"range:{f}"))
    if kind == "tag":
        e = e.when(~r.isin(list(allowed)), F.lit(f"enum:{f}"))
    return e
