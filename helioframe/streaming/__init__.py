"""Structured Streaming entry points (incremental ingest of measurement files)."""
from helioframe.streaming.incremental_ingest import measurement_stream, start_ingest  # noqa: F401
