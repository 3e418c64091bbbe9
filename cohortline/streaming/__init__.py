"""Incremental extraction with Structured Streaming."""

from cohortline.streaming.incremental import stream_table_events

__all__ = ["stream_table_events"]
