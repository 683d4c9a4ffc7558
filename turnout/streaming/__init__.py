"""Streaming ingestion of raw load batches."""

from .loads import ingest_loads, rejected_lines  # noqa: F401
