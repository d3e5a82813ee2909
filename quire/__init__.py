"""quire: editorial content curation as Spark DataFrame jobs.

Subpackages
-----------
functions  column expressions (URL hashing, lax JSON decode, text, time)
sources    table loaders and the fixture tables derived from the test data
operators  DataFrame -> DataFrame steps (discover, fetch, dedupe, enrich,
           store, mirror, sync-back, schema check, metrics)
plans      end-to-end batch runs built from the operators
streaming  incremental runs of the same plans with Structured Streaming
"""

__all__ = ["config", "session", "schemas"]
