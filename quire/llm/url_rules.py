"""URL filters: hand-written rules first, then association rules mined from labels.

FP-growth mines combinations of URL tokens from labelled URLs. Tokens that stand
in exactly the same URLs are one item there, so a template of many fixed parts is
one item and not a combination for each of their subsets. Combinations that
imply the bad label with enough confidence and support become rules; a rule with
a part that does as well by itself is pruned. Rules are found by an inverted
index: each is filed under its rarest token, joined to the tokens of the URLs,
and checked for its other tokens.

Each different URL is matched once, however many rows carry it.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: (verdict, host, path): fits the host and its subdomains where the path starts so.
BASE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_COUNT = 25  #: labelled URLs that hold a rule's tokens and the label, at least, at every size
MIN_CONFIDENCE = 0.8
BAD = "label:bad"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def base_rule(host: Column, path: Column, rules=BASE_RULES) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                      F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def url_tokens(url: Column) -> Column:
    """Different tokens: host labels, path words, and names of query parameters.

    Digits count as one sign, so that numbered pages share their tokens.
    """
    def part(text: Column, cut: str, mark: str) -> Column:
        plain = F.filter(F.split(F.regexp_replace(F.lower(text), "[0-9]+", "0"), cut), lambda t: t != "")
        return F.transform(plain, lambda t: F.concat(F.lit(mark), t))

    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.split_part(q, F.lit("="), F.lit(1)))
    return F.array_distinct(F.concat(
        part(host_of(url), r"\.", "host:"), part(path_of(url), r"[^\p{L}\p{N}]+", "path:"),
        F.transform(names, lambda n: F.concat(F.lit("query:"), F.lower(n)))))


def _items(baskets: DataFrame, min_count: int) -> DataFrame:
    """``item, tokens``: frequent tokens, those that stand in exactly the same URLs as one item.

    Equal counts and equal sums of URL hashes tell them; an item holds no more
    tokens than a URL has.
    """
    spread = baskets.select(F.xxhash64("url").alias("h"), F.explode("tokens").alias("token"))
    sums = spread.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("sum"))
    return written(sums.where(F.col("n") >= min_count).groupBy("n", "sum").agg(
        F.min("token").alias("item"), F.sort_array(F.collect_list("token")).alias("tokens")).select("item", "tokens"), "url-items")


def mine_rules(labelled: DataFrame, min_support: float = 0.0, min_count: int = MIN_COUNT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``tokens, anchor, confidence, support`` of the rules in ``url, bad`` rows.

    Every labelled URL counts; ``support`` is the number of bad ones that hold
    the tokens. ``min_support`` asks for a share of the labelled URLs besides.
    A rule names all tokens of its items. Rows with a null in either
    column are left out; too few rows give no rules.
    """
    spark = labelled.sparkSession
    none = spark.createDataFrame([], "tokens array<string>, anchor string, confidence double, support long")
    rows = labelled.where("url is not null and bad is not null")
    baskets = written(rows.select(F.monotonically_increasing_id().alias("row"), "url", "bad",
                                  url_tokens(F.col("url")).alias("tokens")), "url-baskets")
    total = baskets.count()
    min_count = max(min_count, math.ceil(min_support * total))
    items = _items(baskets, min_count)
    label = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    spread = baskets.select("row", "bad", F.explode("tokens").alias("item")).join(items.select("item"), "item", "left_semi")
    found = written(spread.groupBy("row", "bad").agg(F.collect_list("item").alias("items"))
                    .select(F.concat("items", label).alias("items")), "url-itemsets")
    n = found.count()
    if n < min_count:
        return none
    model = FPGrowth(itemsCol="items", minSupport=min_count / n, minConfidence=min_confidence,
                     numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(found)
    rules = written(
        model.associationRules.where(F.col("consequent")[0] == BAD)
        .select(F.sort_array("antecedent").alias("items"), "confidence",
                F.round(F.col("support") * n).cast("long").alias("support")), "url-rules")
    # a rule goes if one with one item less does as well; by steps that covers all its parts
    shorter = F.explode(F.transform("items", lambda t: F.array_remove("items", t)))
    part = rules.select(F.col("items").alias("part"), F.col("confidence").alias("part_confidence"))
    weak = (rules.select("items", "confidence", shorter.alias("part")).join(part, "part")
            .where("part_confidence >= confidence").select("items").distinct())
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
    whole = (rules.join(weak, "items", "left_anti").select("*", F.explode("items").alias("item"))
             .join(single, "item").join(items, "item")
             .groupBy("items", "confidence", "support").agg(
                 F.min(F.struct("freq", "item"))["item"].alias("anchor"),
                 F.sort_array(F.flatten(F.collect_list("tokens"))).alias("tokens")))
    return written(whole.select("tokens", "anchor", "confidence", "support"), "url-index")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, tokens, confidence``: the best rule (by confidence, support, tokens) of each
    different ``url`` that has one."""
    held = urls.select("url").distinct().withColumn("held", url_tokens(F.col("url")))
    found = (held.withColumn("anchor", F.explode("held")).join(rules, "anchor")
             .where(F.size(F.array_except("tokens", "held")) == 0))
    best = found.groupBy("url").agg(F.max(F.struct("confidence", "support", "tokens")).alias("best"))
    return best.select("url", "best.tokens", "best.confidence")


def judge_urls(pages: DataFrame, labelled: DataFrame, rules=BASE_RULES, id_col: str = "page_id",
               url_col: str = "url", **mining) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule, confidence`` per row of ``pages``.

    The longest hand-written rule decides; else a mined rule blocks, and without
    one the URL is allowed. Null URLs and those without ``://`` have empty host
    and path, and no hand-written rule fits them. Repeated rows are judged each;
    other columns are ignored; an empty table gives no rows.
    """
    url = F.col("url")
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select(
        "page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    base = base.withColumn("b", base_rule(F.col("host"), F.col("path"), rules))
    mined = match_rules(base.where("b is null and url is not null"), mine_rules(labelled, **mining))
    mined = mined.withColumnRenamed("url", "__url")
    joined = base.join(mined, (F.col("url") == F.col("__url")) & F.col("b").isNull(), "left")
    verdict = F.coalesce("b.verdict", F.when(F.col("tokens").isNotNull(), "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", F.col("b.rule").alias("rule"), verdict.alias("verdict"),
                         F.array_join("tokens", " ").alias("mined_rule"), "confidence")
