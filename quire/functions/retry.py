"""Rate-limit retry decisions for failed discovery/fetch calls.

A call error whose text contains "rate limit" (any case) is retryable while
fewer than ``max_retries`` retries were made; the wait is the
"retry after <n>s" hint, or the fallback, plus a pad. Other errors fail at
once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the rate-limit message.
RATE_LIMIT_MARK = r"(?i)rate limit"
RETRY_AFTER_HINT = r"(?i)retry after (\d+)\s*s"


def is_rate_limited(err) -> Column:
    return F.coalesce(err.rlike(RATE_LIMIT_MARK), F.lit(False))


def retry_wait_sec(err, fallback: float = 60.0, pad: float = 2.0) -> Column:
    hint = F.nullif(F.regexp_extract(err, RETRY_AFTER_HINT, 1), F.lit(""))
    return F.coalesce(hint.try_cast("double"), F.lit(float(fallback))) + F.lit(float(pad))


def retry_action(err, attempt, max_retries: int = 3) -> Column:
    return (F.when(is_rate_limited(err) & (attempt < max_retries), F.lit("retry"))
            .otherwise(F.lit("fail")))
