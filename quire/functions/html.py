"""Body text of a raw HTML page with native regex steps.

The original delegates this to a remote scraper that returns Markdown; this
is our own definition: drop comments, script/style/nav/head blocks, turn
line-break and block tags into newlines, strip the remaining tags, decode
five entities, and squeeze blank runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Regex steps (pattern, replacement), applied in order.
HTML_STEPS = (
    (r"(?s)<!--.*?-->", ""),
    (r"(?is)<head\b[^>]*>.*?</head\s*>", ""),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", ""),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", ""),
    (r"(?is)<nav\b[^>]*>.*?</nav\s*>", ""),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</(p|div|h[1-6]|li|tr|article|section)\s*>", "\n"),
    (r"<[^>]*>", ""),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", "\""),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
    (r"[ \t]+\n", "\n"),
    (r"\n{3,}", "\n\n"),
)


def html_to_text(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    for pat, rep in HTML_STEPS:
        col = F.regexp_replace(col, pat, rep)
    return F.btrim(col, F.lit(" \t\n\r"))
