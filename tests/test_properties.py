"""Property tests: expressions against plain-Python definitions on random
text (each hypothesis example is one batch of strings, so one Spark job)."""

import hashlib
from datetime import date, datetime, timedelta, timezone

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.functions import text as tx
from quire.functions.timeparse import to_epoch_ms

WS = list(tx.PY_WHITESPACE)
# text mixing ASCII, slashes, Python whitespace and astral characters
chars = st.sampled_from(list("ab/:.x-") + WS + ["é", "😀", "中"])
texts = st.lists(st.text(chars, max_size=40), min_size=1, max_size=200)


@settings(max_examples=5, deadline=None)
@given(texts)
def test_url_hash_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for r in df.select("s", tx.url_hash("s").alias("h")).collect():
        assert r.h == hashlib.sha256(r.s.strip().rstrip("/").encode()).hexdigest()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(chars, min_size=0, max_size=60), min_size=1, max_size=100))
def test_truncate_property(spark, values):
    """Never over the cap; short texts stay; cut ones are a prefix without
    white space at its end, and the mark."""
    cap = 20  # small, so that random strings cross it
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for r in df.select("s", tx.truncate_text("s", cap).alias("t")).collect():
        assert len(r.t) <= cap
        if len(r.s) <= cap:
            assert r.t == r.s
        else:
            head = r.t.removesuffix("...")
            assert head != r.t and r.s.startswith(head) and not head[-1:].isspace()
            assert not r.s[len(head): cap - 3].strip()


def py_lax_score(present, v):
    """The lax integer rule (with the 0..10 range) in plain Python:
    (value or None, error kind or None)."""
    import re
    if not present:
        return None, "missing"
    if isinstance(v, bool):
        n = int(v)
    elif isinstance(v, int):
        n = v
    elif isinstance(v, float):
        if v != int(v):
            return None, "type"
        n = int(v)
    elif isinstance(v, str) and re.fullmatch(r" *[+-]?[0-9]+(\.0+)? *", v):
        n = int(float(v))
    else:
        return None, "type"
    return (n, None) if 0 <= n <= 10 else (None, "range")


json_values = st.one_of(
    st.integers(-20, 20), st.floats(-20, 20, allow_nan=False).map(lambda x: round(x, 1)),
    st.booleans(), st.none(), st.text(st.sampled_from(list("0123456789 .+-x")), max_size=6),
    st.integers(-20, 20).map(lambda i: f" {i} "), st.integers(0, 12).map(lambda i: f"{i}.0"))
cases = st.lists(st.tuples(st.booleans(), json_values), min_size=1, max_size=100)


@settings(max_examples=5, deadline=None)
@given(cases)
def test_lax_int_property(spark, items):
    import json
    from quire.operators.enrich import decode_node
    payloads = []
    for present, v in items:
        body = {"quality_score": 3, "reason": "r"}
        if present:
            body["relevance_score"] = v
        payloads.append(json.dumps(body))
    df = spark.createDataFrame([(i, p, None) for i, p in enumerate(payloads)],
                               "doc_id long, response string, error string")
    got = {r.doc_id: (r.sc_relevance_score, r.sc_err) for r in decode_node(df, "score").collect()}
    for i, (present, v) in enumerate(items):
        value, kind = py_lax_score(present, v)
        g_value, g_err = got[i]
        assert g_value == value, (v, got[i])
        assert (g_err is None) == (kind is None), (v, got[i])
        if kind is not None:
            assert g_err == f"{kind}:relevance_score", (v, got[i])


# datetime text -> epoch ms: each text is written from the instant it stands for

def pad(n, w, p):
    return str(n).zfill(w) if p else str(n)

@st.composite
def dated(draw):
    """(text, epoch ms): a date, with or without time, fraction and zone."""
    day = draw(st.dates(date(1971, 1, 1), date(2099, 12, 31)))
    text = day.isoformat()
    at = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
    if draw(st.booleans()):
        at += timedelta(seconds=draw(st.integers(0, 86399)))
        text += draw(st.sampled_from("T ")) + at.strftime("%H:%M:%S")
        if draw(st.booleans()):
            ms = draw(st.integers(0, 999))
            at += timedelta(milliseconds=ms)
            text += f".{ms:03d}"
        zone = draw(st.sampled_from(["", "Z", "+08:00", "-05:30"]))
        at -= {"+08:00": timedelta(hours=8), "-05:30": -timedelta(hours=5, minutes=30)}.get(zone, timedelta())
        text += zone
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return draw(st.sampled_from(["", " ", "  "])) + text + draw(st.sampled_from(["", " "])), (at - epoch) // timedelta(milliseconds=1)


@settings(max_examples=5, deadline=None)
@given(st.lists(dated(), min_size=1, max_size=200))
def test_epoch_property(spark, values):
    df = spark.createDataFrame(values, "s string, want long")
    bad = [tuple(r) for r in df.select("s", "want", to_epoch_ms("s").alias("ms")).collect() if r.ms != r.want]
    assert not bad, bad[:10]


TRUE_S, FALSE_S = ("1", "on", "t", "true", "y", "yes"), ("0", "off", "f", "false", "n", "no")


def py_lax_bool(present, v):
    if not present:
        return None, "missing"
    if isinstance(v, bool):
        return v, None
    if isinstance(v, (int, float)):
        return (v == 1, None) if v in (0, 1) else (None, "type")
    if isinstance(v, str):
        if v.lower() in TRUE_S:
            return True, None
        if v.lower() in FALSE_S:
            return False, None
    return None, "type"


bool_values = st.one_of(st.booleans(), st.integers(-2, 3), st.sampled_from([0.0, 1.0, 0.5]),
                        st.none(), st.sampled_from(list(TRUE_S + FALSE_S) + ["YES", "No", "x", "", "2"]))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.booleans(), bool_values), min_size=1, max_size=100))
def test_lax_bool_property(spark, items):
    import json
    from quire.operators.enrich import decode_node
    base = {f: "" for f in ("title_zh", "title_en", "excerpt_zh", "excerpt_en", "author", "country",
                            "published_at", "notes", "review_notes")}
    payloads = []
    for present, v in items:
        body = dict(base, read_minutes=1)
        if present:
            body["needs_revision"] = v
        payloads.append(json.dumps(body))
    df = spark.createDataFrame([(i, p, None) for i, p in enumerate(payloads)],
                               "doc_id long, response string, error string")
    got = {r.doc_id: (r.rv_needs_revision, r.rv_err) for r in decode_node(df, "review").collect()}
    for i, (present, v) in enumerate(items):
        value, kind = py_lax_bool(present, v)
        assert got[i][0] == value, (v, got[i])
        assert got[i][1] == (None if kind is None else f"{kind}:needs_revision"), (v, got[i])
