"""ISO week dates against Python's own parser."""

from datetime import datetime, timezone

from quire.functions.timeparse import to_epoch_ms


def python_ms(text):
    try:
        d = datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    except ValueError:
        return None
    return round((d if d.tzinfo else d.replace(tzinfo=timezone.utc)).timestamp() * 1000)


def test_week_dates_are_python_s(spark):
    texts = [f"{y}-W{w:02d}-{d}" for y in range(2014, 2034) for w in (0, 1, 2, 26, 52, 53, 54) for d in (1, 4, 7)]
    texts += ["2026-W18", "2026W18", "2026W187", "2026-W18-8", "2026-W18-0", "2026-W1-1", "2026-w18-1", "2026-W18-7T10:20:30",
              "2026-W18-7 10:20", "2026-W18-7T10:20:30.250+02:00", "2026-W18-7T10Z", "2020-W53-5", "2021-W53-1", " 2026-W18-7\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.ms for r in rows.select("t", to_epoch_ms("t").alias("ms")).collect()}
    assert got == {t: python_ms(t) for t in texts}
    assert sum(v is not None for v in got.values()) > 250
