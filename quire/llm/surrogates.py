"""PII surrogates: detected entities get keyed replacements of their own kind.

Mentions are found where the texts are read. Different entities are a table of
their own: each gets a candidate surrogate from a keyed SHA-256 stream that fits
its type (an address keeps its shape, a card its check digit, a name its gender
and script). Candidates that meet another entity's surrogate, or a real value of
the corpus, are drawn again until none do, so different entities stay different
and a surrogate names nobody in the corpus. All mentions of an entity get the
same surrogate, in the format of the mention.

Only texts with mentions meet the table of their surrogates; the others pass by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, let, whole_text
from .spans import running_sums

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: A domain name has 127 labels at most; the bound keeps the match's stack small.
EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,127}[A-Za-z]{2,}"
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
PHONE = (r"(?<![\w.+-])\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
         r"|(?<![\w.+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])")
SSN = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
CARD = (r"(?<![\w+-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
        r"(?![\w-])")
#: Titles by which person names are known, by gender (n: any). Fixed values.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "госпожа"),
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Господин", "господин"),
    "n": ("Dr", "Prof", "Professor", "Doctor", "Доктор", "доктор", "Профессор", "профессор"),
}
#: Titles are also written in capitals.
TITLES = {g: tuple(dict.fromkeys((*names, *(n.upper() for n in names)))) for g, names in TITLES.items()}
_TITLE = "|".join(sorted((t for names in TITLES.values() for t in names), key=len, reverse=True))
#: Capitalised or all in capitals, and either after an initial with an apostrophe (O'Brien).
_NAME_PART = r"(?:\p{Lu}['’])?\p{Lu}(?:\p{L}*\p{Ll}|\p{Lu}+)"
NAME = rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLE})\.? {_NAME_PART}(?:[ -]{_NAME_PART}){{0,2}}(?!\p{{L}})"
MENTION = "|".join((EMAIL, IP, SSN, PHONE, CARD, NAME))
TYPES = ("email", "ip", "ssn", "phone", "card", "name")

#: Syllables and last sounds of invented names. Fixed values.
SYLLABLES = {
    "latin": ("ba", "del", "fi", "gor", "han", "jel", "ka", "lor", "mi", "nev", "or", "pel", "ra", "sil", "tam", "ver"),
    "cyrillic": ("ба", "дел", "фи", "гор", "хан", "зел", "ка", "лор", "ми", "нев", "ор", "пел", "ра", "сил", "там", "вер"),
}
ENDINGS = {"latin": {"f": "ina", "m": "ard", "n": "is", "s": "sen"},
           "cyrillic": {"f": "ина", "m": "ард", "n": "ис", "s": "енко"}}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string, whose last digit is the check digit."""
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(
        d.cast("int") * (F.lit(1) + i % 2), lambda x: x - F.when(x > 9, 9).otherwise(0))),
        F.lit(0), lambda a, x: a + x)


def mention_type(mention: Column) -> Column:
    """The type of a match of MENTION; null for a number without a card's check digit."""
    return (F.when(mention.contains("@"), "email").when(mention.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), "ip")
            .when(mention.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(mention.rlike(r"^\p{L}"), "name")
            .when(mention.rlike(r"^\+|^\(|^[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$"), "phone")
            .when(luhn_sum(_digits(mention)) % 10 == 0, "card"))


def _name_body(mention: Column) -> Column:
    return F.regexp_replace(mention, rf"^(?:{_TITLE})\.? ", "")


def entities(mention: Column) -> Column:
    """array<struct<type, value>>: what a mention names.

    A phone is its last ten digits, so that it is one with and without country
    code. A name is its parts: the last a surname, the others given names of the
    title's gender.
    """
    female, male = (mention.rlike(rf"^(?:{'|'.join(TITLES[g])})\.? ") for g in "fm")

    def name(words: Column) -> Column:
        # all parts of the last word are surnames, joined by hyphens or not
        return F.flatten(F.transform(words, lambda w, i: F.transform(F.split(w, "-"), lambda p: F.struct(
            F.concat(F.lit("name-"), F.when(p.rlike(r"^\p{IsCyrillic}"), "cyrillic").otherwise("latin"), F.lit("-"),
                     F.when(i == F.size(words) - 1, "s").when(female, "f").when(male, "m").otherwise("n")).alias("type"),
            F.lower(p).alias("value")))))

    def plain(kind: Column) -> Column:
        digits = _digits(mention)
        value = (F.when(kind == "email", F.lower(mention)).when(kind == "phone", F.right(digits, F.lit(10)))
                 .when(kind.isin("ssn", "card"), digits).otherwise(mention))
        return F.array(F.struct(kind.alias("type"), value.alias("value")))

    none = F.array().cast("array<struct<type:string,value:string>>")
    return let(mention_type(mention), lambda kind: F.when(kind.isNull(), none).when(
        kind == "name", let(F.split(_name_body(mention), " "), name)).otherwise(plain(kind)))


def _stream(key: str, *parts: Column) -> Column:
    """Hexadecimal keyed digits, four for each of the first 64 characters."""
    return F.concat(*(F.sha2(F.concat_ws("\x01", F.lit(key), F.lit(str(i)), *parts), 256) for i in range(4)))


def _draw(stream: Column, i: Column | int, below: int) -> Column:
    at = (i if isinstance(i, Column) else F.lit(i)) % 64
    return F.conv(F.substring(stream, at * 4 + 1, F.lit(4)), 16, 10).cast("int") % below


def _reshape(text: Column, stream: Column) -> Column:
    """Letters and digits drawn anew, each of its kind; other characters stay."""
    def one(c: Column, i: Column) -> Column:
        letter = F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), _draw(stream, i, 26) + 1, F.lit(1))
        return (F.when(c.rlike("^[0-9]$"), _draw(stream, i, 10).cast("string"))
                .when(c.rlike("^[a-z]$"), letter).otherwise(c))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def candidate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The surrogate value that an entity draws at an attempt. From the fifth on
    it grows with each, so that no type runs out."""
    extra = F.greatest(attempt - 4, F.lit(0))

    def of(s: Column) -> Column:
        longer = F.concat(F.split_part(value, F.lit("@"), F.lit(1)), F.repeat(F.lit("x"), extra))
        domain = F.split_part(value, F.lit("@"), F.lit(2))
        labels = F.regexp_replace(domain, r"\.[a-z]+$", "")
        email = F.concat(_reshape(longer, s), F.lit("@"), _reshape(labels, _stream(key, F.lit("domain"), domain)),
                         F.lit(".example"))
        ip = F.concat_ws(".", *((_draw(s, i, 254) + 1).cast("string") for i in range(4)))
        ssn = F.concat(F.lit("9"), _reshape(F.substring(value, 2, 8), s), F.repeat(F.lit("0"), extra))
        # neither an area nor an exchange begins with 0 or 1
        phone = F.concat((_draw(s, 63, 8) + 2).cast("string"), _reshape(F.substring(value, 2, 2), s),
                         (_draw(s, 62, 8) + 2).cast("string"), F.substring(_reshape(F.substring(value, 2, 9), s), 4, 6),
                         F.repeat(F.lit("0"), extra))
        body = F.concat(F.substring(value, 1, 1), _reshape(F.substring(value, F.lit(2), F.length(value) - 2), s))
        card = let(body, lambda b: F.concat(b, ((F.lit(10) - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
        name = F.lit(None).cast("string")
        for script, syllables in SYLLABLES.items():
            table = F.array(*map(F.lit, syllables))
            for role, ending in ENDINGS[script].items():
                drawn = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(3) + extra),
                                                 lambda i: table[_draw(s, i, len(syllables))]), "")
                name = F.when(kind == f"name-{script}-{role}", F.concat(drawn, F.lit(ending))).otherwise(name)
        return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ssn", ssn)
                .when(kind == "phone", phone).when(kind == "card", card).otherwise(name))

    return let(_stream(key, kind, value, attempt.cast("string")), of)


def assign_surrogates(found: DataFrame, key: str) -> DataFrame:
    """``type, value, surrogate`` of the different entities in ``type, value`` rows.

    One surrogate an entity, no two entities of a type the same, and none equal
    to a real value of its type. Of several that draw the same one the least
    value keeps it; the others draw again, against all that are given.
    """
    known = cut(found.select("type", "value").distinct())
    given = None
    pending = known.withColumn("attempt", F.lit(0))
    while True:
        drawn = cut(pending.withColumn("surrogate", candidate(key, F.col("type"), F.col("value"), F.col("attempt"))))
        taken = known.select("type", F.col("value").alias("surrogate"))
        if given is not None:
            taken = taken.unionByName(given.select("type", "surrogate"))
        free = drawn.join(taken, ["type", "surrogate"], "left_anti")
        first = free.groupBy("type", "surrogate").agg(F.min("value").alias("value"))
        given = cut(first if given is None else given.unionByName(first))
        pending = cut(drawn.join(given, ["type", "value"], "left_anti")
                      .select("type", "value", (F.col("attempt") + 1).alias("attempt")))
        if pending.isEmpty():
            return given.select("type", "value", "surrogate")


def _fill_digits(mention: Column, digits: Column) -> Column:
    """The mention with its last digits replaced; more digits than it has are appended."""
    have = F.length(_digits(mention))

    def of(d: Column) -> Column:
        keep = have - F.least(F.lit(10), have)
        chars = F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike("^[0-9]$"), let(
            F.length(_digits(F.substring(mention, F.lit(1), i + 1))) - keep,
            lambda at: F.when(at > 0, F.substring(d, at, F.lit(1))).otherwise(c))).otherwise(c))
        return F.concat(F.array_join(chars, ""), F.substring(d, F.least(F.lit(10), have) + 1, F.lit(20)))

    return let(digits, of)


def _capital(name: Column) -> Column:
    return F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, F.lit(2), F.length(name)))


def _cased(name: Column, like: Column) -> Column:
    """The surrogate in the case of what it replaces: all capitals, or capitalised."""
    return F.when((F.length(like) > 1) & (like == F.upper(like)), F.upper(name)).otherwise(_capital(name))


def _bare(gap: Column, names: Column) -> Column:
    """struct<text, n>: text between mentions, in which capitalised words that are parts
    of the document's ``names`` (array<struct<value, surrogate>>) have their surrogates."""
    def word(token: Column) -> Column:
        at = F.when(token.rlike(r"^\p{Lu}"), F.array_position(names["value"], F.lower(token))).otherwise(0)
        return let(at, lambda i: F.when(i > 0, F.struct(
            _cased(F.get(names["surrogate"], (i - 1).cast("int")), token).alias("text"), F.lit(1).alias("n"))).otherwise(
            F.struct(token.alias("text"), F.lit(0).alias("n"))))

    # between letters and others; an apostrophe after an initial stays with its name
    return let(F.transform(F.split(gap, r"(?<=\p{L})(?=\P{L})(?!(?<=\b\p{Lu})['’]\p{Lu})|(?<=\P{L})(?=\p{L})(?<!\b\p{Lu}['’])", -1), word), lambda words: F.struct(
        F.array_join(words["text"], "").alias("text"), F.aggregate(words["n"], F.lit(0), lambda a, n: a + n).alias("n")))


def render(mention: Column, surrogates: Column) -> Column:
    """A mention written with the surrogates of its entities (array<string>)."""
    whole = surrogates[0]
    title = F.regexp_extract(mention, rf"^(?:{_TITLE})\.? ", 0)
    parts = F.regexp_extract_all(_name_body(mention), F.lit("[^ -]+"), F.lit(0))
    marks = F.regexp_extract_all(_name_body(mention), F.lit("[ -]"), F.lit(0))
    name = F.concat(title, F.array_join(F.transform(surrogates, lambda x, i: F.concat(
        _cased(x, F.get(parts, i)), F.coalesce(F.get(marks, i), F.lit("")))), ""))
    spaced = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike("^[0-9]$"), F.substring(
        whole, F.length(_digits(F.substring(mention, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")
    ssn = F.concat_ws("-", F.substring(whole, 1, 3), F.substring(whole, 4, 2), F.substring(whole, F.lit(6), F.length(whole)))
    return let(mention_type(mention), lambda kind: F.when(kind.isin("email", "ip"), whole).when(
        kind == "phone", _fill_digits(mention, whole)).when(kind == "card", spaced).when(kind == "ssn", ssn).otherwise(name))


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities``; all other columns stay.

    A name that a title marks in a text is replaced there without the title too,
    where its parts are capitalised; ``n_entities`` counts such words with the
    mentions. ``key`` decides the surrogates; the same key and corpus give the same ones.
    Null and empty texts, and those without a mention, stay as they are. A
    column named ``n_entities`` is replaced. Rows
    that repeat both id and text get the same text; null ids are allowed; an
    empty table gives no rows. Texts are read whole.
    """
    docs = docs.drop("n_entities")
    has = whole_text().rlike(MENTION)
    texts = docs.where(has).withColumn("__key", F.xxhash64("text"))
    found = (texts.select(F.col("doc_id").alias("__id"), "__key", F.posexplode(
        F.regexp_extract_all("text", F.lit(MENTION), F.lit(0))).alias("at", "mention"))
        .select("__id", "__key", "at", "mention", F.posexplode(entities(F.col("mention"))).alias("part", "e"))
        .select("__id", "__key", "at", "mention", "part", "e.type", "e.value"))
    found = cut(found)
    chosen = found.join(assign_surrogates(found, key), ["type", "value"])
    written = (chosen.groupBy("__id", "__key")
               .agg(F.sort_array(F.collect_set(F.struct("at", "part", "surrogate", "type", "value"))).alias("__drawn")))
    joined = texts.withColumnRenamed("__key", "__own").join(
        written, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left")

    def rebuilt(mentions: Column) -> Column:
        def by_place(drawn: Column) -> Column:
            # the drawn rows are in order of place: each place takes its own stretch
            counts = F.transform(mentions, lambda m: F.size(entities(m)))
            return let(let(counts, lambda n: F.arrays_zip(n.alias("n"), running_sums(n).cast("array<int>").alias("end"))),
                       lambda z: F.transform(
                mentions, lambda m, i: F.when(z[i]["n"] == 0, m).otherwise(render(m, F.transform(
                    F.slice(drawn, z[i]["end"] - z[i]["n"] + 1, z[i]["n"]), lambda d: d["surrogate"])))))

        gaps = F.split(F.col("text"), MENTION, -1)
        # the first of equal parts counts, as a bare word doesn't tell its role
        names = F.transform(F.filter("__drawn", lambda d: d["type"].startswith("name-")), lambda d: F.struct(
            d["value"].alias("value"), d["surrogate"].alias("surrogate")))
        own = let(names, lambda known: F.transform(gaps, lambda g: F.when(F.size(known) > 0, _bare(g, known)).otherwise(
            F.struct(g.alias("text"), F.lit(0).alias("n")))))
        return let(own, lambda rest: F.struct(
            F.array_join(F.flatten(F.zip_with(rest["text"], by_place(F.col("__drawn")), lambda g, r: F.array(
                g, F.coalesce(r, F.lit(""))))), "").alias("text"),
            F.aggregate(rest["n"], F.lit(0), lambda a, n: a + n).alias("n")))

    joined = joined.withColumn("__new", F.when(F.col("__drawn").isNotNull(), let(
        F.regexp_extract_all("text", F.lit(MENTION), F.lit(0)), rebuilt)))
    text = F.coalesce("__new.text", "text")
    changed = joined.select(*(text.alias(c) if c == "text" else c for c in docs.columns),
                            F.coalesce(F.size(F.array_distinct(F.transform(
                                "__drawn", lambda d: d["at"]))) + F.col("__new.n"), F.lit(0)).cast("long").alias("n_entities"))
    return docs.where(~has).withColumn("n_entities", F.lit(0).cast("long")).unionByName(changed)
