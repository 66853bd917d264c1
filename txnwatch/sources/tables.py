"""Batch table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet scan; a declared ``schema`` skips footer-based inference.

    Split sizes belong to ``spark.sql.files.maxPartitionBytes``: no shuffle is added here.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)
