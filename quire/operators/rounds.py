"""Calls that are retried in rounds.

A round asks all open requests at once and is written. Failed ones that the
retry policy allows (rate limits, up to so many retries) make up the next
round; the others are final. Rounds go on until none is open, so a request is
never asked again once it is answered, and a restarted run keeps the rounds that
it finished.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.retry import is_rate_limited, retry_action, retry_wait_sec
from ..session import path_done


def ask_in_rounds(requests: DataFrame, ask: Callable[[DataFrame], DataFrame], keys: tuple[str, ...], path: str,
                  max_retries: int = 3, fallback: float = 60.0, pad: float = 2.0,
                  pause: Callable[[float], None] = time.sleep) -> DataFrame:
    """The last answer of each request: what ``ask`` returned, with ``attempts`` (calls made)
    and ``waited_sec`` (what its errors asked to wait, in sum).

    ``ask`` takes the open requests with ``attempt`` (0 for the first call) and
    returns their ``keys``, an ``error`` (null if answered) and any other
    columns; it is called once a round, and its result is written to
    ``path/round=<n>``. ``keys`` tell requests apart. Before a round the driver
    waits (``pause``) as long as the most patient error of the last one asks.
    """
    spark = requests.sparkSession
    requests = requests.withColumn("_waited", F.lit(0.0))
    columns = None
    for attempt in range(max_retries + 1):
        folder = f"{path}/round={attempt}"
        open_calls = requests.withColumn("attempt", F.lit(attempt))
        if path_done(spark, folder):
            n, wait = _again(spark.read.parquet(folder)).agg(F.count("_wait"), F.max("_wait")).first()
        else:
            # what earlier rounds waited goes by the keys, beside the answers
            answers = ask(open_calls.drop("_waited"))
            if attempt:
                answers = answers.join(requests.select(*keys, "_waited"), list(keys), "left")
            else:
                answers = answers.withColumn("_waited", F.lit(0.0))
            error, tried = F.col("error"), F.lit(attempt)
            wait_sec = F.when(retry_action(error, tried, max_retries) == "retry", retry_wait_sec(error, fallback, pad))
            # every rate limit has been waited for, the last one's wait has no call after it
            seen = Observation()
            answers.withColumn("_wait", wait_sec).observe(
                seen, F.count("_wait").alias("n"), F.max("_wait").alias("wait")).write.mode("overwrite").parquet(folder)
            n, wait = seen.get["n"], seen.get["wait"]
        done = spark.read.parquet(folder)
        columns = columns or [c for c in done.columns if c not in ("_wait", "_waited")]
        if not n:
            break
        again = _again(done).select(*keys, (F.col("_waited") + F.col("_wait")).alias("_waited"))
        requests = requests.drop("_waited").join(again, list(keys))
        pause(wait)
    rounds = spark.read.parquet(path)
    return rounds.where("_wait is null").select(
        *columns, (F.col("round") + 1).alias("attempts"), F.col("_waited").alias("waited_sec"))


def _again(answers: DataFrame) -> DataFrame:
    return answers.where("_wait is not null")


def dead_letters(answers: DataFrame) -> DataFrame:
    """Requests that are given up, with ``reason``: other errors, or a rate limit met too often."""
    return answers.where("error is not null").withColumn(
        "reason", F.when(is_rate_limited(F.col("error")), F.lit("retries_used_up")).otherwise(F.lit("not_retryable")))
