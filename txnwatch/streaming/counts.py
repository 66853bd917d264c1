"""STR-1/3/4/5 on a live stream: watermarked window counts, append mode."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnwatch.config import DEFAULT_WATERMARK
from txnwatch.functions.time import as_event_time
from txnwatch.operators.windows import window_counts


def streaming_window_counts(parsed: DataFrame, key: str, duration: str, slide: str | None = None,
                            watermark: str = DEFAULT_WATERMARK, out: str = "txn_count") -> DataFrame:
    """Per-key counts over event-time windows of a parsed stream.

    Rows later than the watermark are dropped by Spark's state management;
    in append mode a window is emitted once, after the watermark passes its end.
    """
    timed = parsed.withColumn("timestamp", as_event_time(parsed, "timestamp"))
    return window_counts(timed.withWatermark("timestamp", watermark), key, duration, slide,
                         out=out)
