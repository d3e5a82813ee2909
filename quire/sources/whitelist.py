"""Source whitelist (name, type, url, url_pattern) from YAML or JSON lines.

The whitelist is a small configuration file read on the driver; it becomes
a DataFrame with a positional ``source_id`` (two entries may share a URL).
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SOURCES_RAW


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    p = Path(path)
    text = p.read_text(encoding="utf-8")
    if p.suffix in (".yaml", ".yml"):
        try:
            import yaml  # optional dependency
        except ImportError as exc:  # pragma: no cover - depends on the image
            raise RuntimeError("PyYAML is not installed; use a .json/.jsonl whitelist") from exc
        entries = yaml.safe_load(text) or []
    elif p.suffix == ".json":
        entries = json.loads(text or "[]") or []
    else:
        entries = [json.loads(line) for line in text.splitlines() if line.strip()]
    rows = []
    for i, e in enumerate(entries):
        e = e or {}
        # an absent name defaults to ''; an explicit null stays null
        rows.append((str(i), e.get("name", ""), e.get("type"), e.get("url"), e.get("url_pattern")))
    return spark.createDataFrame(rows, SOURCES_RAW)
