"""Structured Streaming form of the chunked raw ingestion."""

from claimlens.streaming.ingest import stream_typed, start_ingest  # noqa: F401
