"""End-to-end batch runs: ingest (discover -> store -> mirror -> metrics)
and sync-back (mirror statuses -> store)."""
