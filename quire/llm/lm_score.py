"""Stupid-backoff scores of documents, computed relationally.

Words and word pairs of all documents are counted in two halves, and a document
is scored by the counts of the half it isn't in: a pair (v, w) seen there scores
ln c(v w) - ln c(v), any other ln 0.4 + ln c(w) - ln N (Brants et al. 2007). At
order three a triple (u, v, w) seen there scores ln c(u v w) - ln c(u v), any
other ln 0.4 more than its pair; only triples that both halves hold are looked up.

Pairs of the commonest words are counted with map-side sums and looked up in a
small table. All other pairs are dealt out by hash once; each task counts its
pairs there, next to the documents that hold them, and sums scores by document.
Common words travel as short numbers, so a dealt row is a number and a document.

Logarithms are millionths rounded to whole numbers: sums don't depend on order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, whole_text, written

MICRO = 1_000_000
BACKOFF = 0.4
KNOWN_BITS = 20  #: at most 2 ** 20 common words get numbers; the table of them is broadcast
HOT_BITS = 10  #: at most 2 ** 10 of them are hot; at most 2 ** 20 pairs of hot words are broadcast
START = "<s>"


def fold_of(doc_id: Column) -> Column:
    """0 or 1, by the first digit of the id's MD5 (a null id: 0)."""
    digit = F.conv(F.substring(F.md5(doc_id.cast("string")), 1, 1), 16, 10)
    return F.coalesce(digit.cast("int") % 2, F.lit(0))


def lm_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def micro_log(count: Column) -> Column:
    """ln of a count (at least 1) in millionths, rounded half up."""
    return F.floor(F.log(F.greatest(count, F.lit(1)).cast("double")) * MICRO + 0.5).cast("long")


def _tokens(text_col: str) -> Column:
    """The start mark and the words."""
    return F.concat(F.array(F.lit(START)), lm_words(whole_text(text_col)))


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, fold, h``: the hashes of the start mark and the words of each row."""
    return docs.select(F.col(id_col).alias("doc_id"), fold_of(F.col(id_col)).alias("fold"),
                       F.transform(_tokens(text_col), lambda w: F.xxhash64(w)).alias("h"))


def word_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``fold, h`` of each start mark and word.

    The tokens are exploded as an expression: of a column, the optimizer would
    ask whether it is empty first, and split each text twice.
    """
    rows = docs.select(fold_of(F.col(id_col)).alias("fold"), F.col(text_col).alias("text"))
    return rows.select("fold", F.explode(_tokens("text")).alias("w")).select("fold", F.xxhash64("w").alias("h"))


def _fold_counts() -> list[Column]:
    return [F.sum(F.when(F.col("fold") == f, 1).otherwise(0)).cast("long").alias(f"c{f}") for f in (0, 1)]


def _other(zero: str = "c0", one: str = "c1") -> Column:
    """What the half that a row's document isn't in has."""
    return F.when(F.col("fold") == 0, F.col(one)).otherwise(F.col(zero))


def _least_count(sizes: list, bits: int) -> int:
    """The least power of two that at most ``2 ** bits`` words reach."""
    total, least = 0, max((r["power"] for r in sizes), default=0) + 1
    for r in sorted(sizes, key=lambda r: -r["power"]):
        total += r["n"]
        if total > 1 << bits:
            break
        least = r["power"]
    return 1 << least


def word_counts(rows: DataFrame) -> DataFrame:
    """``h, c0, c1``: each word's count in either half; START counts documents."""
    return written(rows.groupBy("h").agg(*_fold_counts()), "lm-words")


def known_words(counts: DataFrame, known_bits: int, hot_bits: int) -> DataFrame:
    """``h, id, hot, c0, c1`` of the common words: at most ``2 ** known_bits`` rows."""
    power = F.floor(F.log2((F.col("c0") + F.col("c1")).cast("double"))).cast("int")
    sizes = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()  # 64 rows at most
    known, hot = (_least_count(sizes, b) for b in (known_bits, hot_bits))
    rows = counts.where(F.col("c0") + F.col("c1") >= known).repartition(64, "h")
    number = F.monotonically_increasing_id()
    rows = rows.withColumn("m", number)
    part = F.shiftleft(F.shiftright("m", 33), known_bits)  # no task has more rows than all together
    return cut(rows.select("h", part.bitwiseOR(F.col("m").bitwiseAND(F.lit((1 << 33) - 1))).alias("id"),
                           (F.col("c0") + F.col("c1") >= hot).alias("hot"), "c0", "c1"))


def _triple_parts(hashed: DataFrame, counts: DataFrame, backoff: float) -> DataFrame:
    """``doc_id, value, n, n_seen``: what order three adds to the scores of order two."""
    def runs(length: int) -> Column:
        size = F.greatest(F.size("h") - length + 1, F.lit(0))
        return F.inline(F.arrays_zip(*(F.slice("h", F.lit(i + 1), size).alias(f"h{s}")
                                       for i, s in enumerate("uvw"[-length:]))))

    def shared(rows: DataFrame, *keys: str) -> DataFrame:
        return cut(rows.groupBy(*keys).agg(*_fold_counts()).where("c0 > 0 and c1 > 0"))

    triples = hashed.select("doc_id", "fold", runs(3))
    # a triple that both halves hold has pairs and words that both hold
    pairs = shared(hashed.select("fold", runs(2)), "hv", "hw")
    named = {"x": (pairs, ("hu", "hv"), ("hv", "hw")), "y": (pairs, ("hv", "hw"), ("hv", "hw")), "z": (counts, ("hv",), ("h",))}
    found = shared(triples, "hu", "hv", "hw")
    for s, (table, to, own) in named.items():
        found = found.join(table.select(*(F.col(a).alias(b) for a, b in zip(own, to)),
                                        F.col("c0").alias(f"{s}0"), F.col("c1").alias(f"{s}1")), list(to))
    scores = cut(found.select("hu", "hv", "hw", *(
        (micro_log(F.col(f"c{1 - f}")) - micro_log(F.col(f"x{1 - f}")) - F.lit(_log_lit(backoff))
         - micro_log(F.col(f"y{1 - f}")) + micro_log(F.col(f"z{1 - f}"))).alias(f"s{f}") for f in (0, 1))))
    zero = F.lit(0).cast("long")
    none = (zero.alias("n"), zero.alias("n_seen"))
    seen = triples.join(scores, ["hu", "hv", "hw"]).select("doc_id", _other("s1", "s0").alias("value"), *none)
    unseen = F.greatest(F.size("h") - 2, F.lit(0)).cast("long") * F.lit(_log_lit(backoff))
    return seen.unionByName(hashed.select("doc_id", unseen.alias("value"), *none))


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", backoff: float = BACKOFF,
              known_bits: int = KNOWN_BITS, hot_bits: int = HOT_BITS, order: int = 2) -> DataFrame:
    """``doc_id, n_words, n_seen, score_micro, mean_logprob`` per ``doc_id``.

    Words are lower-cased runs of letters and digits of the whole text; the
    first follows a start mark, which is counted once a document. ``order``: two
    or three words; the first word has the start mark alone before it. ``n_seen``:
    words whose pair the other half holds. A count of zero under a logarithm
    counts as one. ``known_bits`` and ``hot_bits`` bound the broadcast tables
    and change no result. Texts without words (null, empty) have a null mean.
    Rows that share an id (or have none) are one document; other columns are
    ignored; an empty table gives no rows.
    """
    if order not in (2, 3):
        raise ValueError(f"order {order} is neither 2 nor 3")
    hashed = _hashed(docs, id_col, text_col)
    counts = word_counts(word_rows(docs, id_col, text_col))
    start = F.xxhash64(F.lit(START))
    totals = counts.where(F.col("h") != start).agg(
        F.coalesce(F.sum("c0"), F.lit(0)), F.coalesce(F.sum("c1"), F.lit(0))).first()
    known = known_words(counts, known_bits, hot_bits)
    # of an unseen pair, by the fold of its document: ln 0.4 - ln N of the other half
    unseen = [_log_lit(backoff) - _log_lit(max(totals[1 - f], 1)) for f in (0, 1)]

    others = F.size("h") - 1
    pairs = hashed.select("doc_id", "fold", F.inline(F.arrays_zip(
        F.slice("h", F.lit(1), others).alias("hv"), F.slice("h", F.lit(2), others).alias("hw"))))

    def with_words(words: DataFrame, how: str) -> DataFrame:
        out = pairs
        for s in "vw":
            named = words.select(F.col("h").alias(f"h{s}"), F.col("id").alias(f"id{s}"), F.col("hot").alias(f"hot{s}"))
            out = out.join(F.broadcast(named), f"h{s}", how)
        return out

    number = F.shiftleft("idv", 32).bitwiseOR(F.col("idw"))
    first, second = F.shiftright("k", 32), F.col("k").bitwiseAND(F.lit((1 << 32) - 1))

    # pairs of hot words: at most 4 ** hot_bits rows of counts, and of scores for either fold
    hot = known.where("hot")
    hot_pairs = with_words(hot, "inner").select("doc_id", "fold", number.alias("k"))
    hot_counts = cut(hot_pairs.groupBy("k").agg(*_fold_counts()))
    sides = [hot.select(F.col("id").alias(s), F.col("c0").alias(f"{s}0"), F.col("c1").alias(f"{s}1")) for s in "vw"]
    hot_scores = cut(hot_counts.withColumns({"v": first, "w": second}).join(F.broadcast(sides[0]), "v")
                     .join(F.broadcast(sides[1]), "w").select("k", *(x for f in (0, 1) for x in (
                         F.when(F.col(f"c{1 - f}") > 0, micro_log(F.col(f"c{1 - f}")) - micro_log(F.col(f"v{1 - f}")))
                         .otherwise(F.lit(unseen[f]) + micro_log(F.col(f"w{1 - f}"))).alias(f"s{f}"),
                         (F.col(f"c{1 - f}") > 0).cast("long").alias(f"seen{f}")))))
    hot_part = hot_pairs.join(F.broadcast(hot_scores), "k").select(
        "doc_id", _other("s1", "s0").alias("value"), F.lit(1).cast("long").alias("n"),
        _other("seen1", "seen0").alias("n_seen"))

    # the others: by hash, counted where they meet; rare words keep their hashes
    both = F.col("idv").isNotNull() & F.col("idw").isNotNull()
    rest = with_words(known, "left").where(~F.coalesce(F.col("hotv") & F.col("hotw"), F.lit(False))).select(
        "doc_id", "fold", F.when(both, number).otherwise(F.col("hv")).alias("k"),
        F.when(~both, F.col("hw")).alias("rare"))
    same = Window.partitionBy("k", "rare")
    rest = rest.select("doc_id", "fold", "k", "rare", F.count(F.lit(1)).over(same).alias("all"),
                       F.sum("fold").over(same).alias("ones"))
    seen = F.when(F.col("fold") == 0, F.col("ones")).otherwise(F.col("all") - F.col("ones"))
    is_seen = F.col("seen") > 0
    # one known count decides: the first word's if the pair is seen, else the second's
    logs = known.select(F.col("id").alias("at"), micro_log(F.col("c0")).alias("l0"), micro_log(F.col("c1")).alias("l1"))
    rest = rest.select(
        "doc_id", "fold", seen.alias("seen"), "k", "rare").select(
        "doc_id", "fold", "seen", F.when(F.col("rare").isNull(), F.when(is_seen, first).otherwise(second)).alias("at"),
        F.when(F.col("rare").isNotNull(), F.when(is_seen, F.col("k")).otherwise(F.col("rare"))).alias("x"))
    sign = F.when(is_seen, -1).otherwise(1)
    value = F.when(is_seen, micro_log(F.col("seen"))).when(F.col("fold") == 0, F.lit(unseen[0])).otherwise(F.lit(unseen[1]))
    rest = rest.join(F.broadcast(logs), "at", "left").select(
        "doc_id", "fold", "x", (value + F.coalesce(sign * _other("l0", "l1"), F.lit(0))).alias("value"),
        F.when(F.col("x").isNotNull(), sign).otherwise(0).alias("sign"), F.lit(1).cast("long").alias("n"),
        is_seen.cast("long").alias("n_seen"))

    sums = ("value", "n", "n_seen")
    parts = cut(rest.groupBy("doc_id", "fold", "x").agg(*(F.sum(c).alias(c) for c in (*sums, "sign"))))
    rare = parts.where("x is not null").join(counts, F.col("x") == F.col("h")).select(
        "doc_id", (F.col("value") + F.col("sign") * micro_log(_other())).alias("value"), "n", "n_seen")
    zero = F.lit(0).cast("long")
    all_parts = (hot_part.unionByName(parts.where("x is null").select("doc_id", *sums)).unionByName(rare)
                 .unionByName(hashed.select("doc_id", *(zero.alias(c) for c in sums))))
    if order == 3:
        all_parts = all_parts.unionByName(_triple_parts(hashed, counts, backoff))
    out = all_parts.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in sums))
    return out.select("doc_id", F.col("n").alias("n_words"), "n_seen", F.col("value").alias("score_micro"),
                      F.when(F.col("n") > 0, F.round(F.col("value") / MICRO / F.col("n"), 6)).alias("mean_logprob"))


def _log_lit(value: float) -> int:
    return round(math.log(value) * MICRO)
