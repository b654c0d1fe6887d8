"""Structured Streaming operators: feedback ingest, live counters, the
retraining trigger, periodic re-index counts, cache suppression, rolling
history and incremental indexing (G1-G8)."""
