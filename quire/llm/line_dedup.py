"""Line dedup by winnowing over line hashes.

A text's lines with words give a row of hashes, one for each started 100
characters, so that a long line weighs like several short ones. Of each window
of consecutive hashes the least is selected: two runs of a window's length that
are equal share a selected hash (winnowing, Schleimer et al. 2003). Selected
hashes that occur once in the corpus end there. The others are joined with
their positions and extended both ways to every window they stand for; windows
that occurred before, by document id and position, mark their lines.

A line goes if it lies in a window's run of hashes that occurred before. An
occurrence is held against the first one only, so a passage in very many
documents costs a row per occurrence, never a pair.

``dedup_passages`` finds repeats wherever they stand in a line, in any script.
A line is cut into units between two words whose hash says so, and after so many
words, so a passage has the same units in every text but for those at its ends
that are glued to other words. Windows of units are runs, and so are single lines
of enough words, and windows of lines with a short one among them. Of a window of
units the fingerprint is the least hash of neighbours, as a unit may be a single
frequent word. Fingerprints go through the shuffle with their segment's hash alone,
and only segments of texts that hold one met twice are extended to their windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_RUN, SPACES, cut, let, whole_text, written
from .spans import running_sums

WINDOW = 3  #: hashes in a run that counts as a repeat
CHARS = 100  #: characters of a line that weigh as one hash
LINE_WORDS = 8  #: words of a line that is a run by itself
LINE_CHARS = 200  #: or its characters, beyond these
LINE_WINDOW = 3  #: lines in a run if some of them are shorter
UNIT_WINDOW = 5  #: units in a run that counts as a repeat
UNIT_GRAM = 2  #: neighbouring units that are hashed together for a fingerprint: one alone may be a frequent word
UNIT_WORDS = 6  #: words of a unit, at most
CUT_ONE_IN = 5  #: between two words a line is cut with this chance, by their hash
SEGMENT = 128  #: windows of a text looked at in one row
#: Characters of scripts without blanks between words, each of which counts as one: Thai, Lao, Myanmar,
#: Khmer, Japanese and Han. Fixed values, as ranges, which a pattern tests faster than scripts.
_SOLID = (r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3005\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF"
          r"\x{20000}-\x{2FA1F}")
_BLANK = r"\x20\x09-\x0D"
TOKEN = rf"[{_SOLID}]|[^{_BLANK}{_SOLID}]+"
TOKEN_AND_BLANKS = rf"(?:{TOKEN})[{_BLANK}]*+"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hashes(text: Column, chars: int) -> Column:
    """array<struct<hash, line>> of the lines with words, in order."""

    def of_line(line: Column, at: Column) -> Column:
        weight = F.ceil(F.char_length(line) / F.lit(chars)).cast("int")
        own = let(F.xxhash64(line), lambda h: F.transform(
            F.sequence(F.lit(1), weight),
            lambda j: F.struct(F.xxhash64(h, j).alias("hash"), at.alias("line"))))
        return F.when(F.translate(line, SPACES, "") != "", own).otherwise(
            F.array().cast("array<struct<hash:bigint,line:int>>"))

    return F.flatten(F.transform(_lines(text), of_line))


def _selected(hashes: Column, window: int) -> Column:
    """Each selected hash with the windows whose least it is (the last of equals):
    array<struct<print, runs: array<struct<at, run, first, last>>>>."""

    def least(start: Column) -> Column:
        part = F.reverse(F.slice(hashes, start + 1, window)["hash"])
        return (start + window - F.array_position(part, F.array_min(part))).cast("int")

    def with_runs(picks: Column) -> Column:
        def runs(pick: Column) -> Column:
            near = F.sequence(F.greatest(F.lit(0), pick - window + 1),
                              F.least(pick, F.size(hashes) - window))
            return F.transform(F.filter(near, lambda s: picks[s] == pick), lambda s: F.struct(
                s.alias("at"), F.xxhash64(F.slice(hashes, s + 1, window)["hash"]).alias("run"),
                hashes[s]["line"].alias("first"), hashes[s + window - 1]["line"].alias("last")))

        return F.transform(F.array_distinct(picks), lambda pick: F.struct(
            hashes[pick]["hash"].alias("print"), runs(pick).alias("runs")))

    starts = F.sequence(F.lit(0), F.size(hashes) - window)
    return F.when(F.size(hashes) >= window, let(F.transform(starts, least), with_runs))


def _repeats(docs: DataFrame, selected: Column) -> DataFrame:
    """``doc_id, text_hash, ranges``: first and last place of the runs that repeat an earlier one."""
    prints = docs.select("doc_id", F.xxhash64(whole_text()).alias("text_hash"), F.explode(selected).alias("p"))
    prints = written(prints.select("doc_id", "text_hash", "p.print", "p.runs"), "line-prints")
    # the sums are checkpointed, so that the joins that follow can split a hot key
    met = cut(prints.groupBy("print").count().where("count > 1").select("print"))
    spot = F.struct("doc_id", "text_hash", F.col("r.at").alias("at"))
    runs = (prints.join(met, "print", "left_semi").withColumn("r", F.explode("runs"))
            .select(F.col("r.run").alias("run"), spot.alias("spot"), F.col("r.first").alias("first"),
                    F.col("r.last").alias("last")))
    earliest = cut(runs.groupBy("run").agg(F.min("spot").alias("earliest"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").drop("n"))
    again = runs.join(earliest, "run").where(~F.col("spot").eqNullSafe(F.col("earliest")))
    return (again.groupBy("spot.doc_id", "spot.text_hash")
            .agg(F.collect_set(F.struct("first", "last")).alias("ranges")))


def repeated_runs(docs: DataFrame, window: int = WINDOW, chars: int = CHARS) -> DataFrame:
    """``doc_id, text_hash, dead``: the lines (0-based) that repeat an earlier run."""
    selected = let(_hashes(whole_text(), chars), lambda h: _selected(h, window))
    return _repeats(docs, selected).select("doc_id", "text_hash", F.array_distinct(F.flatten(F.transform(
        "ranges", lambda r: F.sequence(r["first"], r["last"])))).alias("dead"))


def _unit_starts(tokens: Column) -> Column:
    """Where the units of a line start: at cuts between words, and every ``UNIT_WORDS`` after one."""

    def of(words: Column) -> Column:
        n = F.size(words)
        cuts = F.filter(F.sequence(F.lit(1), n - 1), lambda j: F.pmod(
            F.xxhash64(words[j - 1], words[j]), F.lit(CUT_ONE_IN)) == 0)
        starts = let(cuts, lambda c: F.flatten(F.zip_with(
            F.concat(F.array(F.lit(0)), c), F.concat(c, F.array(n)),
            lambda a, b: F.sequence(a, b - 1, F.lit(UNIT_WORDS)))))
        return F.when(n > 1, starts).when(n == 1, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))

    return let(tokens, of)


def _units(tokens: Column, body, blanks: bool = False) -> Column:
    """``body(slice of tokens)`` for each unit of a line. ``blanks``: tokens have those that follow
    them, which don't move the cuts."""
    def bare(t: Column) -> Column:
        return F.transform(t, lambda w: F.rtrim(w, F.lit(SPACES))) if blanks else t

    return let(tokens, lambda t: let(_unit_starts(bare(t)), lambda starts: F.transform(
        starts, lambda a, i: body(F.slice(t, a + 1, F.coalesce(F.get(starts, i + 1), F.size(t)) - a)))))


def _unit_hashes(text: Column) -> Column:
    """Hashes of the units of a text, in order."""
    return F.flatten(F.transform(_lines(text), lambda line: _units(
        F.regexp_extract_all(line, F.lit(TOKEN), F.lit(0)), lambda unit: F.xxhash64(unit))))


def _has_words(line: Column) -> Column:
    return F.translate(line, SPACES, "") != ""


def _line_hashes(text: Column) -> Column:
    """Hashes of the lines with words, in order; the last bit says whether a line is a run by itself."""

    def of_line(line: Column) -> Column:
        long = (F.char_length(line) > LINE_CHARS) | (F.size(F.split(line, SPACE_RUN)) >= LINE_WORDS)
        return F.xxhash64(line, F.lit("line")).bitwiseAND(F.lit(-2)).bitwiseOR(long.cast("long"))

    return F.transform(F.filter(_lines(text), _has_words), lambda line: of_line(F.trim(line, F.lit(SPACES))))


def _least(hashes: Column, start: Column, window: int) -> Column:
    return F.least(*(F.get(hashes, start + k) for k in range(window)))


def _starts(hashes: Column, window: int) -> Column:
    return F.when(F.size(hashes) >= window, F.sequence(F.lit(0), F.size(hashes) - window)).otherwise(
        F.array().cast("array<int>"))


def _run(hashes: Column, start: Column, window: int, salt: int) -> Column:
    return F.xxhash64(F.lit(salt), *(F.get(hashes, start + k) for k in range(window)))


def _is_long(h: Column) -> Column:
    return h.bitwiseAND(F.lit(1)) == 1


def _some_short(hashes: Column, start: Column) -> Column:
    every = _is_long(F.get(hashes, start))
    for k in range(1, LINE_WINDOW):
        every = every & _is_long(F.get(hashes, start + k))
    return ~every


UNITS, LINES = 0, 1  #: kinds of sequences


def _segments(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, kind, offset, hashes``: a text's hashes in overlapping segments."""

    def cut_up(hashes: Column, kind: int, window: int) -> Column:
        return let(hashes, lambda h: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(h) - window, F.lit(0)), F.lit(SEGMENT)),
            lambda a: F.struct(F.lit(kind).alias("kind"), a.alias("offset"),
                               F.slice(h, a + 1, SEGMENT + window - 1).alias("hashes"))))

    text = whole_text()
    both = F.concat(cut_up(_unit_hashes(text), UNITS, UNIT_WINDOW), cut_up(_line_hashes(text), LINES, LINE_WINDOW))
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.explode(both).alias("s")).select(
        "doc_id", "text_hash", "s.*").where(F.size("hashes") > 0)


def _grams(hashes: Column) -> Column:
    """Hashes of ``UNIT_GRAM`` neighbouring units, in order."""
    return F.transform(_starts(hashes, UNIT_GRAM), lambda s: F.xxhash64(*(F.get(hashes, s + k) for k in range(UNIT_GRAM))))


def _least_gram(grams: Column, start: Column) -> Column:
    return _least(grams, start, UNIT_WINDOW - UNIT_GRAM + 1)


def _prints(kind: Column, hashes: Column) -> Column:
    """array<struct<print, twice>>: fingerprints of a segment, each once, and whether it stands there twice.

    Of each window of units the least hash of neighbours, of each window of lines
    the least hash, and each long line's.
    """

    def of(prints: Column, among: Column) -> Column:
        repeated = let(F.sort_array(among), lambda h: F.array_distinct(F.filter(h, lambda x, i: x == F.get(h, i - 1))))
        return let(repeated, lambda again: F.transform(F.array_distinct(prints), lambda p: F.struct(
            p.alias("print"), F.array_contains(again, p).alias("twice"))))

    units = let(_grams(hashes), lambda g: of(
        F.transform(_starts(hashes, UNIT_WINDOW), lambda s: _least_gram(g, s)), g))
    lines = of(F.concat(F.filter(hashes, _is_long), F.transform(
        F.filter(_starts(hashes, LINE_WINDOW), lambda s: _some_short(hashes, s)),
        lambda s: _least(hashes, s, LINE_WINDOW))), hashes)
    return F.when(kind == UNITS, units).otherwise(lines)


def _met_runs(kind: Column, hashes: Column, met: Column) -> Column:
    """array<struct<run, first, last>>: the windows, within the segment, whose fingerprint was met twice."""

    def runs(starts: Column, least, window: int, salt: int) -> Column:
        return F.transform(F.filter(starts, lambda s: F.array_contains(met, least(s))), lambda s: F.struct(
            _run(hashes, s, window, salt).alias("run"), s.alias("first"), (s + window - 1).alias("last")))

    units = let(_grams(hashes), lambda g: runs(
        _starts(hashes, UNIT_WINDOW), lambda s: _least_gram(g, s), UNIT_WINDOW, UNITS))
    single = F.filter(F.transform(hashes, lambda h, i: F.struct(h.alias("run"), i.alias("first"), i.alias("last"))),
                      lambda r: _is_long(r["run"]) & F.array_contains(met, r["run"]))
    lines = F.filter(_starts(hashes, LINE_WINDOW), lambda s: _some_short(hashes, s))
    return F.when(kind == UNITS, units).otherwise(
        F.concat(single, runs(lines, lambda s: _least(hashes, s, LINE_WINDOW), LINE_WINDOW, LINES)))


def _covered(kind: Column, hashes: Column) -> Column:
    """array<struct<first, last>>: what the runs within a segment cover, if all of them are repeats.

    Of three lines or more each is in a run: a long one by itself, a short one in its windows.
    """
    n = F.size(hashes)
    whole = F.array(F.struct(F.lit(0).alias("first"), (n - 1).alias("last")))
    single = F.filter(F.transform(hashes, lambda h, i: F.when(_is_long(h), F.struct(i.alias("first"), i.alias("last")))),
                      lambda r: r.isNotNull())
    return F.when(n >= F.when(kind == UNITS, UNIT_WINDOW).otherwise(LINE_WINDOW), whole).when(
        kind == LINES, single).otherwise(F.array().cast("array<struct<first:int,last:int>>"))


def repeated_places(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, units, lines``: numbers of units and of lines with words that repeat an earlier run,
    as arrays of ``first, last``, in order and apart from each other."""
    place = F.struct("doc_id", "text_hash", "offset")
    segments = written(_segments(docs).withColumns({
        "h1": F.xxhash64("kind", "hashes"), "h2": F.xxhash64(F.lit(1), "kind", "hashes"),
        "covered": _covered(F.col("kind"), F.col("hashes"))}), "line-hashes")
    # a segment that occurred before is a repeat as a whole; its runs are found where it stands first.
    # The sums are checkpointed, so that the joins that follow can split a hot key
    often = cut(segments.groupBy("h1", "h2").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("h1", "h2", "place"))
    copies = (segments.select("doc_id", "text_hash", "kind", "offset", "covered", "h1", "h2").join(often, ["h1", "h2"])
              .where(~place.eqNullSafe(F.col("place"))).withColumn("r", F.explode("covered")))
    prints = segments.select("h1", F.explode(_prints(F.col("kind"), F.col("hashes"))).alias("p")).select("h1", "p.*")
    # met in two segments that differ, or twice in one
    met = cut(prints.groupBy("print").agg(F.min("h1").alias("least"), F.max("h1").alias("most"), F.max("twice").alias("twice"))
              .where("least <> most or twice").select("print"))
    hits = (prints.select("h1", "print").join(met, "print", "left_semi").groupBy("h1").agg(F.collect_set("print").alias("met"))
            .join(often.select("h1", F.col("h2").alias("often"), "place"), "h1", "left"))
    spot = F.struct("doc_id", "text_hash", (F.col("offset") + F.col("r.first")).alias("first"))
    runs = (segments.drop("covered").join(cut(hits), "h1")
            .where(F.col("often").isNull() | (F.col("often") != F.col("h2")) | place.eqNullSafe(F.col("place")))
            .withColumn("r", F.explode(_met_runs(F.col("kind"), F.col("hashes"), F.col("met"))))
            .select("kind", F.col("r.run").alias("run"), spot.alias("spot"),
                    (F.col("r.last") - F.col("r.first")).alias("more")))
    runs = written(runs, "line-runs")
    earliest = cut(runs.groupBy("run").agg(F.min("spot").alias("earliest"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select("run", "earliest"))
    again = (runs.join(earliest, "run").where(~F.col("spot").eqNullSafe(F.col("earliest")))
             .select("spot.doc_id", "spot.text_hash", "kind", "spot.first", (F.col("spot.first") + F.col("more")).alias("last")))
    whole = copies.select("doc_id", "text_hash", "kind", (F.col("offset") + F.col("r.first")).alias("first"),
                          (F.col("offset") + F.col("r.last")).alias("last"))
    return _as_lists(_merged(again.unionByName(whole)))


def _merged(ranges: DataFrame) -> DataFrame:
    """Ranges of each text and kind as few that don't overlap."""
    order = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (ranges.withColumn("opens", F.when(F.col("first") <= before, 0).otherwise(1))
            .withColumn("island", F.sum("opens").over(order))
            .groupBy("doc_id", "text_hash", "kind", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")))


def _as_lists(ranges: DataFrame) -> DataFrame:
    def of(kind: int) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("first", "last"))))

    return ranges.groupBy("doc_id", "text_hash").agg(of(UNITS).alias("units"), of(LINES).alias("lines"))


def _deduped(docs: DataFrame, window: int, chars: int) -> DataFrame:
    """``docs`` with the new text, and ``__removed``: the number of deleted lines."""
    dead = repeated_runs(docs, window, chars).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("dead").alias("__dead"))
    keyed = docs.withColumn("__key", F.xxhash64(whole_text()))
    joined = keyed.join(dead, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__hash")), "left")
    rest = let(_lines(F.col("text")), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__dead")), lambda i: lines[i]), "\n"))
    text = F.when(F.col("__dead").isNull(), F.col("text")).otherwise(rest)
    return joined.select(*(text.alias(c) if c == "text" else c for c in docs.columns),
                         F.coalesce(F.size("__dead"), F.lit(0)).alias("__removed"))


def dedup_lines(docs: DataFrame, window: int = WINDOW, chars: int = CHARS) -> DataFrame:
    """``docs`` with later repeats of line runs deleted from ``text``, and ``n_removed``.

    A run is ``window`` hashes or more: that many lines, or fewer that hold more
    than ``(window - 1) * chars`` characters. The first run, by least ``doc_id``
    (null first), text hash and position, stays whole; lines between deleted
    ones that have no word go with them. Null and empty texts stay as they are.
    Rows that repeat both id and text count as one document and get the same
    text. All columns stay, but for one named ``n_removed``; an empty table
    gives no rows.
    """
    out = _deduped(docs, window, chars)
    return out.drop("n_removed").withColumnRenamed("__removed", "n_removed")


def _without_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with the new text, and ``__removed``: the number of lines deleted or cut."""
    gone = repeated_places(docs).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("units").alias("__units"),
        F.col("lines").alias("__lines"))
    keyed = docs.withColumn("__key", F.xxhash64(whole_text()))
    joined = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__hash")), "left")

    def flags(ranges: Column) -> Column:
        """True from first to last of each range, false before and between; ends with the last range."""
        return F.flatten(F.transform(ranges, lambda r, i: F.concat(
            F.array_repeat(F.lit(False), r["first"] - F.coalesce(F.get(ranges, i - 1)["last"], F.lit(-1)) - 1),
            F.array_repeat(F.lit(True), r["last"] - r["first"] + 1))))

    def of_line(line: Column, units: Column, gone: Column, dead: Column) -> Column:
        """The line and 0, or what is left of it (null if no word) and 1."""
        left = F.array_join(F.filter(units, lambda unit, i: ~F.coalesce(F.get(dead, i), F.lit(False))), "")
        head = F.regexp_extract(line, rf"^[{_BLANK}]*+", 0)
        return F.when(F.coalesce(gone, F.lit(False)), F.struct(F.lit(None).cast("string").alias("line"), F.lit(1).alias("n"))).when(
            F.exists(dead, lambda d: d), F.struct(F.when(_has_words(left), F.concat(head, F.rtrim(left))).alias("line"), F.lit(1).alias("n"))
        ).otherwise(F.struct(line.alias("line"), F.lit(0).alias("n")))

    def of_text(lines: Column) -> Column:
        units = F.transform(lines, lambda line: F.struct(line.alias("line"), _units(
            F.regexp_extract_all(line, F.lit(TOKEN_AND_BLANKS), F.lit(0)), lambda unit: F.array_join(unit, ""), blanks=True).alias("units")))
        return let(units, lambda u: let(F.struct(
            running_sums(F.transform(u, lambda x: F.size(x["units"]).cast("long"))).alias("units"),
            running_sums(F.transform(u, lambda x: (F.size(x["units"]) > 0).cast("long"))).alias("lines"),
            flags(F.col("__units")).alias("dead"), flags(F.col("__lines")).alias("gone")),
            lambda k: F.transform(u, lambda x, i: of_line(
                x["line"], x["units"],
                F.when(F.size(x["units"]) > 0, F.get(k["gone"], (F.get(k["lines"], i) - 1).cast("int"))),
                F.slice(k["dead"], (F.get(k["units"], i) - F.size(x["units"]) + 1).cast("int"), F.size(x["units"]))))))

    # a line of which no word is left is null here and goes
    new = let(let(_lines(F.col("text")), of_text), lambda lines: F.struct(
        F.array_join(lines["line"], "\n").alias("text"),
        F.aggregate(lines["n"], F.lit(0), lambda a, n: a + n).alias("n")))
    # a generator, as a filter on the new text would be pushed below and make it twice
    out = joined.select("*", F.explode(F.array(F.when(F.col("__units").isNotNull(), new))).alias("__new"))
    text = F.when(F.col("__units").isNull(), F.col("text")).otherwise(F.coalesce(F.col("__new.text"), F.col("text")))
    return out.select(*(text.alias(c) if c == "text" else c for c in docs.columns),
                      F.coalesce("__new.n", F.lit(0)).alias("__removed"))


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with later repeats deleted wherever they stand in a line, and ``n_removed``.

    A run is ``UNIT_WINDOW`` units or more (about 18 words), a single line of
    ``LINE_WORDS`` words or over ``LINE_CHARS`` characters, or ``LINE_WINDOW``
    lines with words. The first of equal runs stays, as in ``dedup_lines``.
    Words deleted within a line take the blanks after them along; a line of
    which no word is left goes. ``n_removed`` is the number of lines that went
    or lost a part. All else is as in ``dedup_lines``.
    """
    return _without_passages(docs).drop("n_removed").withColumnRenamed("__removed", "n_removed")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``dedup_passages`` in the columns of ``docs``, without the documents of which no word is left."""
    emptied = (F.col("__removed") > 0) & (F.translate("text", SPACES, "") == "")
    return _without_passages(docs).where(~emptied).select(docs.columns)
