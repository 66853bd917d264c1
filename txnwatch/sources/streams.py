"""Streaming sources.

A broker feed and a folder of envelope files produce the same
``(value, partition, offset)`` frame, so everything downstream is shared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnwatch.schemas import ENVELOPE


def broker_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None) -> DataFrame:
    """SRC-1: subscribe to a topic; start at ``latest``, tolerate lost offsets.

    ``maxOffsetsPerTrigger`` bounds a micro-batch under bursts (STR-11).
    Needs the Kafka connector on the classpath.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", "false"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()


def envelope_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                         fmt: str = "json") -> DataFrame:
    """Envelope records from files (JSON lines or parquet) as an unbounded table."""
    reader = spark.readStream.schema(ENVELOPE).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
