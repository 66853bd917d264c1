"""AGG-7/AGG-8 as measured on the live job: latency from the stamps in its tables, throughput from the query's own progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROGRESS_SCHEMA = "batch_id BIGINT, rows BIGINT, micros BIGINT"


def latency(alerts: DataFrame, bronze: DataFrame) -> DataFrame:
    """``batch_id, rule_type, micros`` for each alert: from its record's ingest stamp to its own.

    An alert of a row that an earlier batch wrote counts from that batch's stamp. Alerts without their Bronze row are left out.
    """
    key = ["kafka_partition", "kafka_offset"]
    rows = alerts.select(*key, "batch_id", "rule_type", "alert_time").join(bronze.select(*key, "ingest_time"), key)
    return rows.selectExpr("batch_id", "rule_type", "unix_micros(alert_time) - unix_micros(ingest_time) AS micros")


def progress(spark: SparkSession, query) -> DataFrame:
    """A row for each micro-batch with rows that the streaming query still remembers (``numRecentProgressUpdates``, 100 by
    default): its rows and the trigger's time."""
    done = {p["batchId"]: (int(p["batchId"]), int(p["numInputRows"]), 1000 * int(p["durationMs"].get("triggerExecution", 0)))
            for p in query.recentProgress if p["numInputRows"]}
    return spark.createDataFrame(list(done.values()), PROGRESS_SCHEMA)


def throughput(batches: DataFrame) -> DataFrame:
    """One row: ``batches``, ``rows``, rows a second over all triggers and in the fastest; null without any time spent."""
    rate = F.expr("try_divide(1000000.0D * rows, micros)")
    return batches.agg(F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"),
                       F.expr("try_divide(1000000.0D * sum(rows), sum(micros))").alias("rows_per_sec"), F.max(rate).alias("peak_rows_per_sec"))
