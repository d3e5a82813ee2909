"""Secret scans: patterns, and sliding-window entropy over candidate strings.

Three patterns give the base spans. Other runs of key-like characters are
candidates: a window slides over each, the counts of its characters change by
one that enters and one that leaves, and with them the window's Shannon entropy.
A candidate is a secret if its most mixed window passes the threshold of its
character class and no allow-list pattern explains it.

Texts are scanned where they are read, by built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, whole_text
from .spans import spans

_KEYWORD = ("[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
            "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]")
ASSIGN = rf"({_KEYWORD})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_CHARS = 6
ACCESS = "AKIA[A-Z0-9]{16,}"  # a failing shorter run holds no longer one
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
_KEY = "A-Za-z0-9+/=_-"
#: From its first character, a run of key characters that holds a digit or goes from small to capital letters.
CANDIDATE = (rf"(?<![{_KEY}])(?=[{_KEY}]{{{WINDOW}}})(?=[A-Za-z+/=_-]*+[0-9]|[{_KEY}]*?[a-z][A-Z])"
             rf"[{_KEY}]{{{WINDOW},}}+")
#: Letters as words have them: of one case, capitalised, or such joined as in identifiers; or a
#: short number. Repeated groups are possessive, so that Java matches them in a loop: a text of
#: very many joined words needs no deep stack.
_PART = "(?:[A-Z]++(?![a-z])|[A-Za-z]?[a-z]++(?:[A-Z][a-z]{2,}+)*+|[0-9]{1,4}+)"
FIRST_CODE, LAST_CODE = ord("+"), ord("z")
MICRO = 1_000_000
#: Character class -> pattern of the whole candidate, least entropy in bits a character.
CLASSES = {
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", 3.0),
    "mixed": ("^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])", 3.5),
    "cased": ("^(?=.*[A-Za-z])(?=.*[0-9])", 3.7),
    "letters": ("^(?=.*[a-z])(?=.*[A-Z])", 3.5),
}
#: Candidates that look like these are no secrets.
ALLOWED = (
    "^[0-9+/=_-]+$",  # numbers, dates, phone numbers
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    rf"^{_PART}(?:[-_/=+]++{_PART})*+[-_/=+]*$",  # words, paths, numbered names
    "^(sha1|sha256|sha384|sha512|md5)[-=_]",  # named digests
)


def _mixing(count: int) -> int:
    """count * log2(count) in millionths, so that sums are exact."""
    return round(count * math.log2(count) * MICRO) if count else 0


def least_mixing(candidate: Column, window: int = WINDOW) -> Column:
    """The least sum of ``_mixing`` over the windows of an ASCII candidate of at
    least ``window`` characters; entropy is log2(window) - sum / window."""
    table = F.array(*(F.lit(_mixing(c)).cast("long") for c in range(window + 2)))

    def slide(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enters, leaves = codes[i], F.when(i >= window, codes[i - window]).otherwise(-1)
            had = acc["counts"][enters]
            has = F.when(i >= window, acc["counts"][F.greatest(leaves, F.lit(0))]
                         + (leaves == enters).cast("int")).otherwise(1)
            total = acc["sum"] + table[had + 1] - table[had] - table[has] + table[has - 1]
            return F.struct(
                F.transform(acc["counts"], lambda n, code: n + (code == enters).cast("int")
                            - (code == leaves).cast("int")).alias("counts"),
                total.alias("sum"),
                F.when(i >= window - 1, F.least(acc["best"], total)).otherwise(acc["best"]).alias("best"))

        start = F.struct(F.array_repeat(F.lit(0), LAST_CODE - FIRST_CODE + 1).alias("counts"),
                         F.lit(0).cast("long").alias("sum"), F.lit(2**62).cast("long").alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda acc: acc["best"])

    return let(F.transform(F.split(candidate, ""), lambda c: F.ascii(c) - FIRST_CODE), slide)


def is_secret(candidate: Column, window: int = WINDOW) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | candidate.rlike(pattern)
    limit = F.lit(None)
    for pattern, bits in reversed(CLASSES.values()):
        most = math.floor((math.log2(window) - bits) * window * MICRO)
        limit = F.when(candidate.rlike(pattern), F.lit(most)).otherwise(limit)
    return ~allowed & F.coalesce(least_mixing(candidate, window) <= limit, F.lit(False))


def _kind(found: Column, rank: int) -> Column:
    return F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def _text(found: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", names[s["rank"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy`` per row.

    ``spans``: ``kind:start:end`` in code points, end exclusive, by start and
    then kind, comma-joined; ``base_sha256`` digests those of the first three
    kinds. An entropy span that meets a base span is left out. Null and empty
    texts have none; repeated rows and null ids give a row each; other columns
    are ignored; an empty table gives no rows. Texts are read whole.
    """
    text = whole_text(text_col)
    assign = F.filter(spans(text, ASSIGN, group=2), lambda s: F.char_length(s["match"]) >= ASSIGN_CHARS)
    found = docs.select(
        F.col(id_col).alias("doc_id"), _kind(assign, 0).alias("a"), _kind(spans(text, ACCESS), 1).alias("k"),
        _kind(spans(text, HEX), 2).alias("h"),
        F.filter(spans(text, CANDIDATE), lambda s: is_secret(s["match"])).alias("e"))
    base = F.sort_array(F.concat("a", "k", "h"))
    both = found.select("doc_id", *(F.size(c).cast("long").alias(n) for c, n in
                                    (("a", "n_assign"), ("k", "n_access"), ("h", "n_hex"))),
                        let(base, lambda b: F.struct(b.alias("base"), _kind(F.filter("e", lambda s: ~F.exists(
                            b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))), 3).alias("more")))
                        .alias("s"))
    return both.select("doc_id", "n_assign", "n_access", "n_hex",
                       F.sha2(_text(F.col("s.base")), 256).alias("base_sha256"),
                       _text(F.sort_array(F.concat("s.base", "s.more"))).alias("spans"),
                       F.size("s.more").cast("long").alias("n_entropy"))
