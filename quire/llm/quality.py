"""Host-level quality rules.

Every document is measured and held against the rules where it is read. Rule
failures are summed by host; each host's failure rate is shrunk towards an
empirical beta prior, fitted by moments over all hosts, so a host with few
documents is judged by what is usual and a large one by itself. Host verdicts
join back to the documents.

Documents are measured once, into a narrow checkpointed table; a host that holds
many of the documents is summed before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, cut, let, whole_text, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WORD_WINDOW = 3
SYMBOLS = "#*$%&|<>"
#: A host whose shrunk rate of failed documents exceeds this is rejected.
MAX_HOST_RATE = 0.6
#: Documents that the prior weighs: at least so many, so that a few failures don't
#: reject a small host; at most so many, as hosts that are all alike would make it endless.
MIN_PRIOR, MAX_PRIOR = 5.0, 1000.0
#: Rejected hosts that are broadcast; more are joined.
MAX_SENT_HOSTS = 100_000
SALTS = 64
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count_of(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, SPACES, "") != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _words_in_repeats(tokens: Column) -> Column:
    """Words that lie in word windows found twice or more in the text."""
    n = F.size(tokens)
    spots = F.transform(F.sequence(F.lit(0), n - WORD_WINDOW), lambda i: F.struct(
        F.concat_ws(" ", *(tokens[i + k] for k in range(WORD_WINDOW))).alias("window"), i.alias("at")))

    def covered(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, i: (
            (i > 0) & (F.get(ordered, i - 1)["window"] == x["window"]))
            | ((i < F.size(ordered) - 1) & (F.get(ordered, i + 1)["window"] == x["window"])))
        return F.size(F.array_distinct(F.flatten(F.transform(
            twice, lambda x: F.sequence(x["at"], x["at"] + WORD_WINDOW - 1)))))

    def of(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found["window"])) == F.size(found), 0).otherwise(
            let(F.sort_array(found), covered))

    return F.when(n < WORD_WINDOW, 0).otherwise(let(spots, of))


def measure(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and ``MEASURES`` (long) of each row's whole text (null: empty)."""
    text = whole_text(text_col)
    counts = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _words_in_repeats(w).cast("long").alias("n_repeat_words")))
    return docs.select(
        *keep, counts.alias("__w"),
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        _count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        _repeated_lines(text).cast("long").alias("n_dup_lines"),
    ).select(*keep, *(F.col(f"__w.{c}" if c in ("n_words", "n_repeat_words") else c).alias(c) for c in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def host_verdicts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``host, n_docs, n_failed, host_rate, host_ok`` of ``host, base_failed`` rows.

    The beta prior has the mean failure rate m over all documents, and the
    strength that explains the spread of the hosts' rates beyond what chance
    makes of their sizes; with no such spread (or one host) it has the most
    strength allowed, and never less than the least. ``host_rate`` = (n_failed + strength * m) / (n_docs + strength).
    A null host is a host of its own.
    """
    hosts = cut(judged.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                           F.sum(F.col("base_failed").cast("long")).alias("n_failed")))
    n, k = F.col("n_docs"), F.col("n_failed")
    sums = hosts.agg(F.sum(n).alias("n"), F.sum(k).alias("k"), F.count(F.lit(1)).alias("hosts"),
                     F.sum(n.cast("double") * n).alias("nn"), F.sum(k.cast("double") * k / n).alias("kk")).first()
    total, hosts_n = sums["n"] or 0, sums["hosts"]
    mean = sums["k"] / total if total else 0.0
    strength = MAX_PRIOR
    spare = total - sums["nn"] / total if total else 0.0
    if spare > 0 and 0 < mean < 1:
        within = mean * (1 - mean)
        # weighted moments: E[sum n_i (p_i - mean)^2] = (hosts - 1) within + between * spare, about
        between = (sums["kk"] - total * mean * mean - (hosts_n - 1) * within) / spare
        if between > 0:
            strength = min(MAX_PRIOR, max(MIN_PRIOR, within / between - 1))
    rate = (k + F.lit(strength * mean)) / (n + F.lit(strength))
    return hosts.select("host", "n_docs", "n_failed", F.round(rate, 6).alias("host_rate"),
                        (rate <= F.lit(max_rate)).alias("host_ok"))


def judge(docs: DataFrame, host_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
          max_rate: float = MAX_HOST_RATE, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the measures, ``base_failed, kept``, and the host's ``host, host_rate`` per row.

    Kept: passes the rules, on a host that isn't rejected. Null and empty texts
    have no words and fail. Repeated rows are judged (and counted) each; rows
    with a null host share one host; other columns are ignored; an empty table
    gives no rows.
    """
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"),
                      F.col(text_col).alias("text"), *carry)
    rows = cut(measure(src, ["doc_id", "host", *carry]).withColumn("base_failed", base_failed()))
    hosts = host_verdicts(rows, max_rate).select(F.col("host").alias("__host"), "host_rate", "host_ok")
    return (rows.join(hosts, F.col("host").eqNullSafe(F.col("__host")))
            .select("doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & F.col("host_ok")).alias("kept"),
                    "host", "host_rate", *carry))


def keep_good(docs: DataFrame, host_col: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps; all columns kept.

    A row's own failure is seen from its own text again, so texts aren't
    shuffled: rejected hosts go to the rows. Beyond ``MAX_SENT_HOSTS`` of them
    the rows are dealt by host and a salt, so that no host lands in one task.
    """
    judged = judge(docs, host_col, max_rate=max_rate)
    bad = cut(judged.where(~F.col("kept") & ~F.col("base_failed")).select(F.col("host").alias("__host")).distinct())
    rows = docs.select(F.struct("*").alias("__row"), F.col("text").alias("__text"))
    good = measure(rows, ["__row"], "__text").where(~base_failed())
    same = F.col(f"__row.{host_col}").eqNullSafe(F.col("__host"))
    if bad.count() <= MAX_SENT_HOSTS:
        return good.join(F.broadcast(bad), same, "left_anti").select("__row.*")
    salt = F.pmod(F.xxhash64("__row.text"), F.lit(SALTS))
    spread = bad.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return good.join(spread, same & (salt == F.col("__part")), "left_anti").select("__row.*")
