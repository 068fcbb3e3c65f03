"""Streaming ingest of landed responses (Structured Streaming)."""

from tallycheck.streaming.ingest_stream import landed_stream, start_ingest_stream

__all__ = ["landed_stream", "start_ingest_stream"]
