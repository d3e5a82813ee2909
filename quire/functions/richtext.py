"""Plain text of review-table cells, which arrive as JSON text.

A text cell may be a string, a list of segments (only object members count,
each contributing its ``text`` or ''), an object with ``text``, null, or
anything else (rendered as its JSON text). A status cell is an object's
``text`` (not stripped) or the stripped string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip


def rich_text(c: str) -> Column:
    v = f"try_parse_json({c})"
    return F.expr(f"""CASE
      WHEN {c} IS NULL THEN ''
      WHEN {v} IS NULL THEN {c}
      ELSE CASE
        WHEN schema_of_variant({v}) = 'VOID' THEN ''
        WHEN schema_of_variant({v}) = 'STRING' THEN try_variant_get({v}, '$', 'string')
        WHEN schema_of_variant({v}) LIKE 'ARRAY%' THEN array_join(transform(
               filter(try_variant_get({v}, '$', 'array<variant>'),
                      x -> schema_of_variant(x) LIKE 'OBJECT%'),
               x -> coalesce(try_variant_get(x, '$.text', 'string'), '')), '')
        WHEN schema_of_variant({v}) LIKE 'OBJECT%'
          THEN coalesce(try_variant_get({v}, '$.text', 'string'), '')
        ELSE to_json({v})
      END
    END""")


def status_text(c: str) -> Column:
    v = f"try_parse_json({c})"
    obj = F.expr(f"coalesce(try_variant_get({v}, '$.text', 'string'), '')")
    is_obj = F.expr(f"coalesce(schema_of_variant({v}) LIKE 'OBJECT%', false)")
    return F.when(is_obj, obj).otherwise(py_strip(rich_scalar(c)))


def rich_scalar(c: str) -> Column:
    """``str(x or "")`` of a JSON cell: strings unquoted, null/false/0 -> ''."""
    v = f"try_parse_json({c})"
    return F.expr(f"""CASE
      WHEN {c} IS NULL THEN ''
      WHEN {v} IS NULL THEN {c}
      WHEN schema_of_variant({v}) IN ('VOID') THEN ''
      WHEN schema_of_variant({v}) = 'STRING' THEN try_variant_get({v}, '$', 'string')
      WHEN schema_of_variant({v}) = 'BOOLEAN'
        THEN CASE WHEN try_variant_get({v}, '$', 'boolean') THEN 'True' ELSE '' END
      WHEN try_variant_get({v}, '$', 'double') = 0 THEN ''
      ELSE to_json({v})
    END""")
