"""Retry rounds, reads by prefix, observed counters and semantic classes."""

import collections
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from quire.config import CurationConfig
from quire.operators import dedupe, enrich, fetch, prefixes, rounds, semantic
from quire.plans import layout
from quire.plans.ingest import IngestInputs, run_ingest
from quire.plans.syncback import run_syncback
from quire.sources import fixtures as fx
from quire.sources.tables import load


# retry rounds -----------------------------------------------------------------
def reference_calls(failures, max_retries=3, fallback=60.0, pad=2.0):
    """Calls made, seconds waited and outcome of one request whose n-th call fails with ``failures[n]``."""
    waited = 0.0
    for attempt in range(max_retries + 1):
        error = failures[attempt] if attempt < len(failures) else None
        if error is None:
            return attempt + 1, waited, None
        if not re.search("rate limit", error, re.I) or attempt == max_retries:
            return attempt + 1, waited, error
        hint = re.search(r"retry after (\d+)\s*s", error, re.I)
        waited += (float(hint[1]) if hint else fallback) + pad


SCHEDULE = {0: [], 1: ["Rate limit, retry after 5 s"], 2: ["rate limit"] * 3, 3: ["rate limit"] * 9, 4: ["bad request"],
            5: ["RATE LIMIT retry after 1s", "timeout"], 6: ["rate limit, retry after 9s", "Rate Limit"]}


def scheduled(pdf):
    def error(i, attempt):
        plan = SCHEDULE[i % 7]
        return plan[attempt] if attempt < len(plan) else None
    errors = [error(i, a) for i, a in zip(pdf["doc_id"], pdf["attempt"])]
    return pd.DataFrame({"doc_id": pdf["doc_id"], "node": pdf["node"], "error": errors,
                         "response": [None if e else "{}" for e in errors]})


def _requests(spark, n=21):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.lit("score").alias("node"), F.lit("p").alias("prompt"))


def test_failed_calls_are_asked_again_as_the_plan_allows(spark, tmp_dir):
    pauses = []
    answers = rounds.ask_in_rounds(_requests(spark), lambda r: enrich.infer(r, scheduled), ("doc_id", "node"),
                                   f"{tmp_dir}/a", pause=pauses.append)
    got = {r.doc_id: (r.attempts, r.waited_sec, r.error) for r in answers.collect()}
    assert got == {i: reference_calls(SCHEDULE[i % 7]) for i in range(21)}
    assert pauses == [62.0, 62.0, 62.0]  # the most patient error of each round
    dead = collections.Counter(r.reason for r in rounds.dead_letters(answers).collect())
    assert dead == {"retries_used_up": 3, "not_retryable": 6}
    # each round holds the open requests only
    asked = {r["round"]: r["n"] for r in spark.read.parquet(f"{tmp_dir}/a").groupBy("round").agg(F.count("*").alias("n")).collect()}
    tried = [reference_calls(SCHEDULE[i % 7])[0] for i in range(21)]
    assert asked == {n: sum(t > n for t in tried) for n in range(4)}


def test_a_restarted_run_keeps_its_rounds(spark, tmp_dir):
    path, keys = f"{tmp_dir}/a", ("doc_id", "node")
    first = rounds.ask_in_rounds(_requests(spark), lambda r: enrich.infer(r, scheduled), keys, path, pause=lambda s: None)
    rows = sorted(map(tuple, first.select("doc_id", "attempts", "waited_sec", "error").collect()))

    def never(df):
        raise AssertionError("asked again")

    again = rounds.ask_in_rounds(_requests(spark), never, keys, path, pause=lambda s: None)
    assert sorted(map(tuple, again.select("doc_id", "attempts", "waited_sec", "error").collect())) == rows


def test_no_round_follows_where_none_is_open(spark, tmp_dir):
    def fine(pdf):
        return pdf[["doc_id", "node"]].assign(response="{}", error=None)

    for n in (5, 0):
        answers = rounds.ask_in_rounds(_requests(spark, n), lambda r: enrich.infer(r, fine), ("doc_id", "node"),
                                       f"{tmp_dir}/{n}", pause=lambda s: pytest.fail("waited"))
        assert answers.count() == n and answers.where("attempts <> 1").count() == 0


def test_answers_yielded_before_a_failure_are_kept():
    asked = []

    def model(pdf):
        for i in range(len(pdf)):
            row = pdf.iloc[i: i + 1]
            asked.append(int(row["doc_id"].iloc[0]))
            if asked[-1] == 3:
                raise RuntimeError("broken")
            yield row[["doc_id", "node"]].assign(response="ok", error=None)

    pdf = pd.DataFrame({"doc_id": range(6), "node": "score", "prompt": "p", "attempt": 0})
    out = enrich.call_model(model, pdf).set_index("doc_id")
    assert sorted(out.index) == list(range(6)) and out.loc[3, "error"] == "RuntimeError: broken"
    assert (out.drop(3)["response"] == "ok").all()
    counts = collections.Counter(asked)
    assert counts == {0: 1, 1: 1, 2: 1, 3: 2, 4: 1, 5: 1}  # the failing row is asked again by itself


def test_fetches_are_retried_in_rounds(spark, tmp_dir):
    kept = spark.createDataFrame([("https://a/1",), ("https://a/2",), ("https://a/2",), (None,)], "url string")

    def fetcher(url):
        if url.endswith("2"):
            raise OSError("429 rate limit")
        return "body"

    cfg = CurationConfig(run_ts="2026-01-01T00:00:00", max_retries=2)
    got = {r.url: r for r in fetch.fetch_in_rounds(kept, fetcher, f"{tmp_dir}/f", cfg, pause=lambda s: None).collect()}
    assert got["https://a/1"].attempts == 1 and got["https://a/1"].markdown == "body"
    assert got["https://a/2"].attempts == 3 and got["https://a/2"].waited_sec == 124.0 and "429" in got["https://a/2"].error


# reads by prefix ----------------------------------------------------------------
@pytest.fixture()
def no_broadcasts(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _scans(df):
    """(path, partitions read) of each file scan of a plan that has run."""
    out = []
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if "FileSourceScanExec" in leaf.getClass().getName():
            metrics = leaf.metrics()
            n = metrics.apply("numPartitions").value() if metrics.contains("numPartitions") else None
            out.append((leaf.relation().location().rootPaths().head().toString(), n))
    return out


def test_stored_hashes_are_read_by_the_prefixes_of_the_batch(spark, tmp_dir, no_broadcasts):
    urls = spark.range(3000).select(F.concat(F.lit("https://x.org/"), "id").alias("article_url"))
    stored = dedupe.hash_urls(urls).select("hash_code", F.lit("u").alias("unique_id"), F.lit("r1").alias("run_id"))
    layout.write_hashes(stored, f"{tmp_dir}/store")
    batch = dedupe.hash_urls(urls.where("article_url like '%/7' or article_url like '%/1234'").unionByName(
        spark.createDataFrame([("https://x.org/new",)], "article_url string")))
    seen = dedupe.seen_hashes(batch, layout.store_hashes(spark, f"{tmp_dir}/store"))
    rows = {r.hash_code for r in seen.collect()}
    assert rows == {r.hash_code for r in batch.where("article_url <> 'https://x.org/new'").collect()}
    (_, n), = [s for s in _scans(seen) if s[0].endswith("article_hashes")]
    assert n <= 3 < 200  # of 256 partitions; a prefix for each of the batch's hashes
    new = dedupe.dedupe_new(batch, layout.store_hashes(spark, f"{tmp_dir}/store"))
    assert [r.article_url for r in new.collect()] == ["https://x.org/new"]


def test_a_store_without_prefixes_is_still_read(spark, tmp_dir):
    stored = spark.createDataFrame([("ab12", "u", "r1"), ("cd34", "v", "r1")], "hash_code string, unique_id string, run_id string")
    layout.write_partition(stored, f"{tmp_dir}/store/article_hashes")
    batch = spark.createDataFrame([("ab12",), ("ee56",), (None,)], "hash_code string")
    seen = dedupe.seen_hashes(batch, layout.store_hashes(spark, f"{tmp_dir}/store"))
    assert [r.hash_code for r in seen.collect()] == ["ab12"]


def test_answers_of_other_articles_are_not_gathered(spark, tmp_dir, no_broadcasts):
    answers = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("hash_code"), F.lit("score").alias("node"),
                                       F.lit('{"relevance_score": 5, "quality_score": 5, "reason": "r"}').alias("response"),
                                       F.lit(None).cast("string").alias("error"))
    layout.write_answers(answers, f"{tmp_dir}/store", "r1")
    mine = spark.createDataFrame([(r.hash_code,) for r in answers.limit(3).collect()], "hash_code string")
    out = enrich.attach_decoded(mine, layout.stored_answers(spark, f"{tmp_dir}/store"), "hash_code", ("score",))
    assert [r.sc_overall_score for r in out.collect()] == [5, 5, 5]
    (_, n), = [s for s in _scans(out) if s[0].endswith("answers")]
    assert n <= 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    assert any("Aggregate" in x for x in lines[:semi])  # narrowed below the gathering aggregate


# observed counters ----------------------------------------------------------------
def test_runs_start_no_count_job(spark, tmp_dir, monkeypatch):
    inp = IngestInputs(sources=fx.sources(spark, SF001), links=fx.links(spark, SF001),
                       bodies=load(spark, SF001, "pages", "url", "html"), responses=fx.link_answers(spark, SF001))
    pull = fx.mirror_pull(spark, SF001)

    def no_count(self):
        raise AssertionError("counted again")

    monkeypatch.setattr(DataFrame, "count", no_count)
    monkeypatch.setattr(type(spark.range(1)), "count", no_count)
    got = run_ingest(spark, inp, f"{tmp_dir}/store", f"{tmp_dir}/out", CurationConfig(run_ts="2026-02-01T00:00:00"))
    sync = run_syncback(spark, pull, f"{tmp_dir}/store", "2026-03-01T00:00:00", "s1")
    monkeypatch.undo()
    assert got["total"] == got["new"] == got["scraped_shape"][0] > 0 and got["skipped"] == 0
    assert sync["total"] == sync["applied"] == 0 < sync["rejected"]  # the pull names no stored article
    empty = IngestInputs(sources=inp.sources, links=inp.links.limit(0), bodies=inp.bodies, responses=inp.responses)
    got = run_ingest(spark, empty, f"{tmp_dir}/store", f"{tmp_dir}/out2", CurationConfig(run_ts="2026-02-02T00:00:00"))
    assert (got["total"], got["skipped"], got["new"], got["scraped_shape"]) == (0, 0, 0, (0, 4))


# semantic classes --------------------------------------------------------------------
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])


def class_brute(rows, threshold):
    ids = [i for i, _ in rows]
    units = np.array([v for _, v in rows])
    units = units / np.linalg.norm(units, axis=1, keepdims=True)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in np.argwhere(units @ units.T >= threshold):
        x, y = find(ids[a]), find(ids[b])
        if x != y:
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_semantic_classes_match_brute_force_with_a_hot_group(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((150, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    hot = base[7]
    rows += [(1000 + i, (hot + 0.12 * rng.standard_normal(32)).tolist()) for i in range(90)]  # a third are near copies
    rows += [(2000 + i, (hot * (i + 1)).tolist()) for i in range(20)]
    chain = base[9].copy()
    for i in range(6):  # each near the one before only
        chain = chain + 0.3 * np.linalg.norm(chain) / np.sqrt(32) * rng.standard_normal(32)
        rows.append((3000 + i, chain.tolist()))
    got = {r.vec_id: r.class_id for r in semantic.semantic_classes(spark.createDataFrame(rows, VECTORS)).collect()}
    want = class_brute(rows, semantic.THRESHOLD)
    assert got == want and len(set(want.values())) < 200
    # recall of the links of every query id against all rows
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    pairs = [(q, i) for q in units if q % 100 == 0 for i in units if i != q and units[q] @ units[i] >= semantic.THRESHOLD]
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.9 * len(pairs)


def test_semantic_blocks_lose_no_class(spark, monkeypatch):
    monkeypatch.setattr(semantic, "BLOCK", 4)
    rng = np.random.default_rng(6)
    rows = [(g * 100 + i, (c + 0.35 * rng.standard_normal(16)).tolist())
            for g, c in enumerate(rng.standard_normal((6, 16))) for i in range(12)]
    got = {r.vec_id: r.class_id for r in semantic.semantic_classes(spark.createDataFrame(rows, VECTORS)).collect()}
    assert got == class_brute(rows, semantic.THRESHOLD)


def test_semantic_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [float("nan"), 1.0]), (8, [None, 1.0]), (9, [float("inf"), 1.0]), (10, [1.0]), (None, [1.0, 0.0]),
            (11, [1e-300, 0.0])]
    df = spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("clash")).withColumn("unit", F.lit("clash"))
    got = {r.vec_id: r.class_id for r in semantic.semantic_classes(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 11: 1, **{i: i for i in range(4, 11)}}
    assert semantic.semantic_classes(df.limit(0)).count() == 0
    assert semantic.semantic_classes(df.where("embedding is null")).count() == 1


def test_bands_follow_size_threshold_and_recall():
    for n in (10, 10_000, 10**9):
        bits, bands = semantic.band_plan(n, 0.9, 0.999)
        same = 1 - np.arccos(0.9) / np.pi
        assert 1 - (1 - same**bits) ** bands >= 0.999 and 1 - (1 - same**bits) ** (bands - 1) < 0.999
    assert semantic.band_plan(10**9)[0] > semantic.band_plan(10**6)[0] > semantic.band_plan(100)[0] - 1


def test_semantic_classes_of_the_table_are_single(spark):
    got = semantic.semantic_classes(load(spark, SF001, "embeddings", "vec_id", "embedding")).collect()
    vectors = {r.vec_id: r.embedding for r in load(spark, SF001, "embeddings", "vec_id", "embedding").collect()}
    assert {r.vec_id: r.class_id for r in got} == class_brute(list(vectors.items()), semantic.THRESHOLD)
