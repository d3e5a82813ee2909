"""Layer 4: end-to-end runs and their invariants (ingest twice adds nothing,
a retried run is idempotent, sync-back converges)."""

import json
from dataclasses import replace

import pandas as pd
import pytest

from conftest import SF001
from quire.config import CurationConfig
from quire.plans import layout
from quire.plans.ingest import IngestInputs, run_ingest
from quire.plans.syncback import run_syncback
from quire.sources import fixtures as fx
from quire.sources.tables import load


def fake_model(pdf: pd.DataFrame) -> pd.DataFrame:
    """A deterministic stand-in model: answers from the prompt text."""
    out = []
    for key, node, prompt in zip(pdf["doc_id"], pdf["node"], pdf["prompt"]):
        n = len(prompt)
        if node == "extract":
            body = {f: f"{f}-{n}" for f in ("title_zh", "title_en", "excerpt_zh", "excerpt_en",
                                             "author", "country", "notes")}
            body.update(published_at="2025-01-02", read_minutes=str(n % 9))
        elif node == "score":
            body = {"relevance_score": n % 11, "quality_score": float(n % 7), "reason": "r"}
        elif node == "generate_tag":
            body = {"tag": ["MARKET", "VISA", "CITY"][n % 3], "tag_reason": "t"}
        else:
            body = {f: f"rev-{f}" for f in ("title_zh", "title_en", "excerpt_zh", "excerpt_en",
                                            "author", "country", "published_at", "notes",
                                            "review_notes")}
            body.update(read_minutes=1, needs_revision="yes" if n % 2 else "no")
        err = "rate limit" if n % 13 == 0 else None
        out.append((key, node, None if err else json.dumps(body), err))
    return pd.DataFrame(out, columns=["doc_id", "node", "response", "error"])


def _inputs(spark):
    d = SF001
    return IngestInputs(sources=fx.sources(spark, d), links=fx.links(spark, d),
                        bodies=load(spark, d, "pages", "url", "html"), model_fn=fake_model,
                        attempts=fx.attempts(spark, d))


def test_ingest_twice_adds_nothing(spark, tmp_dir):
    store_dir, cfg = f"{tmp_dir}/store", CurationConfig(run_ts="2026-02-01T00:00:00")
    inp = replace(_inputs(spark), mirror_snapshot=fx.mirror_snapshot(spark, SF001, cfg.run_id))
    r1 = run_ingest(spark, inp, store_dir, f"{tmp_dir}/out1", cfg, key="hash_code",
                    mirror_snapshot_version=True)
    pushed = spark.read.parquet(r1["mirror_changes"])
    assert pushed.count() == spark.read.parquet(f"{store_dir}/articles").count()
    snap = spark.read.parquet(r1["mirror_snapshot"])
    assert snap.where("action <> 'unchanged'").count() == pushed.count()
    arts = spark.read.parquet(f"{store_dir}/articles")
    n1 = arts.count()
    assert n1 > 0 and r1["new"] >= n1
    assert arts.groupBy("hash_code").count().where("count > 1").count() == 0
    # retrying the same run rewrites its own partition only
    run_ingest(spark, inp, store_dir, f"{tmp_dir}/out1b", cfg, key="hash_code")
    assert spark.read.parquet(f"{store_dir}/articles").count() == n1
    # a later run finds everything already stored
    cfg2 = replace(cfg, run_ts="2026-02-02T00:00:00")
    r2 = run_ingest(spark, _inputs(spark), store_dir, f"{tmp_dir}/out2", cfg2, key="hash_code")
    assert r2["new"] == 0 and r2["skipped"] == r2["total"]
    assert spark.read.parquet(f"{store_dir}/articles").count() == n1
    m = json.loads(spark.read.text(f"{tmp_dir}/out1/metrics").first()[0])
    assert set(m) == {"wall_clock_sec", "tokens", "stages"}
    snap = spark.read.json(f"{tmp_dir}/out1/articles")
    assert snap.where("inserted").count() == n1 and "raw_markdown" in snap.columns
    rejects = spark.read.parquet(f"{tmp_dir}/out1/rejects").count()
    assert snap.where("NOT inserted").count() == rejects
    assert r1["scraped_shape"] == (r1["total"], 4)
    # a run id stands for one set of inputs
    other = replace(_inputs(spark), links=fx.links(spark, SF001).where("pos > 3"))
    with pytest.raises(ValueError):
        run_ingest(spark, other, store_dir, f"{tmp_dir}/out3", cfg, key="hash_code")


def test_failed_page_ends_a_pull_over_its_parts(spark, tmp_dir):
    store_dir = f"{tmp_dir}/store"
    run_ingest(spark, _inputs(spark), store_dir, f"{tmp_dir}/out", CurationConfig(run_ts="2026-02-01T00:00:00"))
    ids = [r.unique_id for r in layout.current_articles(spark, store_dir).orderBy("unique_id").limit(4).collect()]
    schema = "page long, page_ok boolean, pos long, unique_id_cell string, status_cell string"
    cells = [json.dumps(u) for u in ids]
    part1 = spark.createDataFrame([(0, True, 0, cells[0], '"READY"'), (2, False, 200, cells[1], '"READY"')], schema)
    part2 = spark.createDataFrame([(1, True, 100, cells[2], '"READY"'), (3, True, 300, cells[3], '"READY"')], schema)
    assert run_syncback(spark, part1, store_dir, "2026-03-01T00:00:00", "p_b0", "p")["applied"] == 1
    assert run_syncback(spark, part2, store_dir, "2026-03-01T00:00:00", "p_b1", "p")["applied"] == 1
    ready = {r.unique_id for r in layout.current_articles(spark, store_dir).where("status = 'READY'").collect()}
    assert ready == {ids[0], ids[2]}
    assert run_syncback(spark, part2, store_dir, "2026-03-02T00:00:00", "q_b0", "q")["applied"] == 1   # another pull


def test_tag_changes_are_written_and_read(spark, tmp_dir):
    store_dir = f"{tmp_dir}/store"
    run_ingest(spark, _inputs(spark), store_dir, f"{tmp_dir}/out", CurationConfig(run_ts="2026-02-01T00:00:00"))
    ids = [r.unique_id for r in layout.current_articles(spark, store_dir).orderBy("unique_id").limit(2).collect()]
    edits = spark.createDataFrame([(ids[0], "VISA", 9), (ids[1], None, 1)], "unique_id string, tag string, seq long")
    layout.write_tag_changes(edits, store_dir, "2026-03-01T00:00:00", "t1")
    layout.write_tag_changes(spark.createDataFrame([(ids[0], "CITY", 1)], edits.schema), store_dir, "2026-03-02T00:00:00", "t2")
    cur = {r.unique_id: r for r in layout.current_articles(spark, store_dir).collect()}
    assert cur[ids[0]].tag == "CITY" and cur[ids[1]].tag is None
    assert cur[ids[0]].updated_at == "2026-03-02T00:00:00" and cur[ids[0]].status == "REVIEWING"


def test_model_failures_leave_a_full_store(spark, tmp_dir):
    def flaky(pdf):
        if pdf["prompt"].str.len().mod(5).eq(0).any():
            raise RuntimeError("model down")
        return fake_model(pdf)

    inp = replace(_inputs(spark), model_fn=flaky, attempts=None)
    r = run_ingest(spark, inp, f"{tmp_dir}/store", f"{tmp_dir}/out", CurationConfig(run_ts="2026-05-01T00:00:00"))
    arts = spark.read.parquet(f"{tmp_dir}/store/articles")
    assert arts.count() == r["new"] and arts.where("stage_errors like '%model down%' or stage_errors like '%ainvoke%'").count() > 0
    assert set(json.loads(spark.read.text(f"{tmp_dir}/out/metrics").first()[0])["stages"]) <= {"extract", "score", "generate_tag", "review"}


def test_syncback_converges(spark, tmp_dir):
    store_dir = f"{tmp_dir}/store"
    run_ingest(spark, _inputs(spark), store_dir, f"{tmp_dir}/out", CurationConfig(run_ts="2026-02-01T00:00:00"), key="hash_code")
    cur = layout.current_articles(spark, store_dir)
    ids = [r.unique_id for r in cur.orderBy("unique_id").select("unique_id").collect()]
    pull = spark.createDataFrame(
        [(0, True, i, json.dumps(u), json.dumps(["READY", "DISCARD", "PUBLISHED"][i % 3]))
         for i, u in enumerate(ids)],
        "page long, page_ok boolean, pos long, unique_id_cell string, status_cell string")
    s1 = run_syncback(spark, pull, store_dir, "2026-03-01T00:00:00", "sync1")
    assert s1["applied"] == len(ids)
    after = {r.unique_id: r.status for r in layout.current_articles(spark, store_dir).collect()}
    assert all(after[u] == ["READY", "DISCARD", "PUBLISHED"][i % 3] for i, u in enumerate(ids))
    s2 = run_syncback(spark, pull, store_dir, "2026-03-02T00:00:00", "sync2")
    assert s2["applied"] == 0
    # re-running a sync batch is idempotent
    s1b = run_syncback(spark, pull, store_dir, "2026-03-01T00:00:00", "sync1")
    assert s1b["applied"] == len(ids)   # the same changes again, in the same partition
    assert {r.unique_id: r.status for r in layout.current_articles(spark, store_dir).collect()} == after


def test_dedupe_before_fetch_gives_same_store(spark, tmp_dir):
    cfg = CurationConfig(run_ts="2026-04-01T00:00:00")
    run_ingest(spark, _inputs(spark), f"{tmp_dir}/a", f"{tmp_dir}/oa", cfg)
    run_ingest(spark, _inputs(spark), f"{tmp_dir}/b", f"{tmp_dir}/ob", cfg, dedupe_before_fetch=True)
    a = spark.read.parquet(f"{tmp_dir}/a/articles").drop("run_id")
    b = spark.read.parquet(f"{tmp_dir}/b/articles").drop("run_id")
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_whitelist_reader(spark, tmp_dir):
    from quire.operators.discover import prepare_sources
    from quire.sources.whitelist import read_whitelist
    path = f"{tmp_dir}/sources.json"
    with open(path, "w") as f:
        json.dump([{"name": "A", "type": "web", "url": "https://a.org/n", "url_pattern": "/n/[0-9]+"},
                   {"type": "web", "url": "https://b.org/"},
                   {"name": None, "url": "https://c.org/"},
                   {"name": "no url"}, {"name": "blank", "url": ""}], f)
    got = [tuple(r) for r in prepare_sources(read_whitelist(spark, path)).orderBy("source_id").collect()]
    assert got == [("0", "A", "https://a.org/n", "/n/[0-9]+"), ("1", "", "https://b.org/", None),
                   ("2", None, "https://c.org/", None)]
    ypath = f"{tmp_dir}/sources.yaml"
    with open(ypath, "w") as f:
        f.write("- name: A\n  url: https://a.org/n\n- url: https://b.org/\n")
    try:
        import yaml  # noqa: F401
    except ImportError:
        return
    assert read_whitelist(spark, ypath).count() == 2


def test_stream_batch_replay_is_idempotent(spark, tmp_dir):
    """A micro-batch replayed after a failure rewrites only its own partition."""
    from quire.streaming.incremental import ingest_batch
    d, store_dir, cfg = SF001, f"{tmp_dir}/store", CurationConfig(run_ts="2026-02-01T00:00:00")
    batch = fx.scraped(spark, d)
    resp = fx.responses(spark, d)
    ingest_batch(batch, 0, resp, store_dir, cfg)
    first = sorted(map(tuple, spark.read.parquet(f"{store_dir}/articles").collect()))
    n = len(first)
    ingest_batch(batch, 0, resp, store_dir, cfg)      # replay of batch 0
    again = sorted(map(tuple, spark.read.parquet(f"{store_dir}/articles").collect()))
    assert n > 0 and again == first
    ingest_batch(batch, 1, resp, store_dir, cfg)      # the next batch: nothing new
    assert spark.read.parquet(f"{store_dir}/articles").count() == n
