"""Structured Streaming jobs: ingest, quotas on a stream, ledger watch."""
