"""Run one ingest and one sync-back over a test-data folder.

usage: python scripts/run_pipeline.py [sf_dir] [work_dir]

Inputs come from the fixture derivations (sources/links from ``pages``,
bodies = ``pages.html``); the model is a deterministic stand-in run with
``mapInPandas``. Outputs go under work_dir (default: a folder in the
session's checkpoint dir).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def stand_in_model(pdf):
    """Answers built from the prompt text (no remote model offline)."""
    import pandas as pd
    out = []
    for key, node, prompt in zip(pdf["doc_id"], pdf["node"], pdf["prompt"]):
        first = prompt.split("\n", 1)[0][:80]
        n = len(prompt)
        if node == "extract":
            body = {"title_zh": first, "title_en": first, "excerpt_zh": "", "excerpt_en": prompt[-500:],
                    "author": "", "country": "", "published_at": "2026-01-01", "read_minutes": n // 5000,
                    "notes": ""}
        elif node == "score":
            body = {"relevance_score": n % 11, "quality_score": (n // 7) % 11, "reason": "length"}
        elif node == "generate_tag":
            body = {"tag": ("MARKET", "MENTOR", "REPORT", "VISA", "CITY")[n % 5], "tag_reason": "length"}
        else:
            body = {"title_zh": first, "title_en": first, "excerpt_zh": "", "excerpt_en": "",
                    "author": "", "country": "", "published_at": "2026-01-01", "read_minutes": 1,
                    "notes": "", "needs_revision": False, "review_notes": ""}
        out.append((key, node, json.dumps(body, ensure_ascii=False), None))
    return pd.DataFrame(out, columns=["doc_id", "node", "response", "error"])


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from quire.config import CurationConfig
    from quire.plans import layout
    from quire.plans.ingest import IngestInputs, run_ingest
    from quire.plans.syncback import run_syncback
    from quire.session import build_session, shared_path, tune
    from quire.sources import fixtures as fx
    from quire.sources.tables import load

    spark = tune(build_session("local[8]", 8))
    work = sys.argv[2] if len(sys.argv) > 2 else shared_path(spark, "quire", "pipeline",
                                                            str(int(time.time())))
    cfg = CurationConfig(run_ts=time.strftime("%Y-%m-%dT%H:%M:%S"), model_partitions=6)
    inp = IngestInputs(sources=fx.sources(spark, sf_dir), links=fx.links(spark, sf_dir),
                       bodies=load(spark, sf_dir, "pages", "url", "html"),
                       model_fn=stand_in_model, attempts=fx.attempts(spark, sf_dir))
    t0 = time.time()
    res = run_ingest(spark, inp, f"{work}/store", f"{work}/run_{cfg.run_id}", cfg,
                     dedupe_before_fetch=True)
    res["ingest_sec"] = round(time.time() - t0, 2)
    # editors: every third stored article marked READY in the mirror
    cur = layout.current_articles(spark, f"{work}/store")
    pull = cur.select(F.lit(0).cast("bigint").alias("page"), F.lit(True).alias("page_ok"),
                      F.monotonically_increasing_id().alias("pos"),
                      F.concat(F.lit('"'), F.col("unique_id"), F.lit('"')).alias("unique_id_cell"),
                      F.when(F.conv(F.substring("unique_id", 1, 2), 16, 10).cast("int") % 3 == 0,
                             F.lit('"READY"')).otherwise(F.lit('"REVIEWING"')).alias("status_cell"))
    t0 = time.time()
    res["syncback"] = run_syncback(spark, pull, f"{work}/store", cfg.run_ts, f"sync_{cfg.run_id}")
    res["syncback_sec"] = round(time.time() - t0, 2)
    res["stored"] = spark.read.parquet(f"{work}/store/articles").count()
    res["metrics"] = json.loads(spark.read.text(f"{res['out']}/metrics").first()[0])
    print(json.dumps(res, default=str))


if __name__ == "__main__":
    main()
