"""Run parameters (the environment settings of the original tool, as a dataclass)."""

from __future__ import annotations

from dataclasses import dataclass, field

# The article status and tag domains.
STATUSES = ("REVIEWING", "READY", "PUBLISHED", "DISCARD")
TAGS = ("MARKET", "MENTOR", "REPORT", "VISA", "CITY")

# Enrichment stage order.
NODES = ("extract", "score", "generate_tag", "review")


@dataclass(frozen=True)
class CurationConfig:
    # one timestamp per run (ISO text, second precision, naive local time);
    # it names the run, so two runs never share one
    run_ts: str
    # links asked from discovery per source and mode
    max_links: int = 5
    # "discover": the cap applies to discovered links, before the URL filter
    # (what the original code does); "kept": it applies after the filter.
    limit_stage: str = "discover"
    # "collapse": a failed extract makes the tag stage fail outside its own
    # error handling, and the article falls back to its initial state;
    # "accumulate": every stage error is kept and later stages still run.
    on_missing_excerpt: str = "collapse"
    # text cells of the review mirror are cut to this many code points
    text_max: int = 1900
    # rate-limit retry policy for discovery/fetch calls
    max_retries: int = 3
    fallback_sleep_sec: float = 60.0
    extra_pad_sec: float = 2.0
    # rounds in which rate-limited model calls are asked again (the original
    # retries discovery and fetch calls only)
    model_retries: int = 0
    # partitions used for the model-call stage (the original caps concurrent
    # model calls at 6); None leaves it to Spark
    model_partitions: int | None = None
    # prompts per Arrow batch handed to the model callable (each prompt holds
    # a whole article, so the default 10k-row batches could reach gigabytes)
    model_batch_rows: int = 256
    # what the model is told before each node's message (see enrich.SYSTEM_PROMPTS)
    system_prompts: dict | None = None
    statuses: tuple = field(default=STATUSES)
    tags: tuple = field(default=TAGS)

    @property
    def run_id(self) -> str:
        d, t = self.run_ts.split("T")
        return d.replace("-", "") + "_" + t.replace(":", "")
