"""URL normalisation and hashing, mirror cell coercions (text, select,
url, number, boolean, title fallback)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip()/rstrip() remove
# (29 code points): 09 0A 0B 0C 0D 1C 1D 1E 1F 20 85 A0 1680 2000-200A
# 2028 2029 202F 205F 3000.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The placeholder for an article without title or URL.
UNTITLED = "Untitled"
ELLIPSIS = "..."


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """Python ``str.strip()``: Spark's plain trim only removes spaces."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def py_rstrip(c) -> Column:
    return F.rtrim(_c(c), F.lit(PY_WHITESPACE))


def normalize_url(c) -> Column:
    """``(url or "").strip().rstrip("/")``"""
    return F.rtrim(py_strip(F.coalesce(_c(c), F.lit(""))), F.lit("/"))


def url_hash(c) -> Column:
    """SHA-256 hex of the normalised URL; NULL/blank gives the empty-string hash."""
    return F.sha2(normalize_url(c), 256)


def truncate_text(c, max_len: int = 1900) -> Column:
    """Falsy -> ''; up to ``max_len`` code points as is; otherwise the first
    ``max_len-3`` code points, right-stripped, plus '...'."""
    s = _c(c)
    return (F.when(s.isNull() | (s == ""), F.lit(""))
            .when(F.length(s) <= max_len, s)
            .otherwise(F.concat(py_rstrip(F.substring(s, 1, max_len - 3)),
                                F.lit(ELLIPSIS))))


def truthy_text(c) -> Column:
    """NULL for NULL or '' (a falsy text value is omitted from the payload)."""
    s = _c(c)
    return F.when(s != "", s)


def select_value(c, allowed) -> Column:
    s = _c(c)
    return F.when(s.isin(list(allowed)), s)


def url_value(c) -> Column:
    s = _c(c)
    return F.when(s != "", F.struct(s.alias("link"), s.alias("text")))


def number_value(c) -> Column:
    """Number cell: NULL / '' / unparseable -> NULL; zero is kept."""
    return _c(c).try_cast("double")


def title_fallback(title, url) -> Column:
    return F.coalesce(truthy_text(title), truthy_text(url), F.lit(UNTITLED))


def short_id(c) -> Column:
    """The first 8 characters of an id, as shown in logs and reports."""
    return F.substring(_c(c), 1, 8)
