"""Structured Streaming: the fan-out job and streaming window counts."""

from txnwatch.streaming.job import StreamJob, alert_feed, late_rows, read_table

__all__ = ["StreamJob", "alert_feed", "late_rows", "read_table"]
