"""Tables replayed as streams: a file source read to its end, with the sink kept beside its checkpoint and read back."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from txnwatch.config import DEFAULT_WATERMARK
from txnwatch.functions.time import as_event_time
from txnwatch.session import checkpoint_dir
from txnwatch.sources.events import EVENTS_SCHEMA, transactions_from_events


def stream_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one for a query's checkpoint and sink.

    Where spark.checkpoint.dir is unset, a session on this machine alone gets a scratch folder and a cluster an error.
    """
    local = spark.sparkContext.master.startswith("local")
    shared = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="run-stream-") if local else None)
    return f"{shared.rstrip('/')}/{name}-{uuid4().hex}"


def transaction_stream(spark: SparkSession, path: str, watermark: str = DEFAULT_WATERMARK, max_files_per_trigger: int | None = None) -> DataFrame:
    """The transaction view over an events table (a file or a folder of them) as a watermarked stream."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # A single file is taken only as a pattern: the last letter as a set of one.
    path = path.rstrip("/")
    txns = transactions_from_events(reader.parquet(f"{path[:-1]}[{path[-1]}]"))
    return txns.withColumn("timestamp", as_event_time(txns, "timestamp")).withWatermark("timestamp", watermark)


def run_to_end(stream: DataFrame, folder: str, mode: str = "append", reader: SparkSession | None = None) -> DataFrame:
    """Everything ``stream`` yields until its source ends, as the table its sink holds, read by ``reader`` or its own session.

    A second call with the same folder goes on where the first ended.
    """
    spark = stream.sparkSession
    query = (stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
             .trigger(availableNow=True).start(f"{folder}/sink"))
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return (reader or spark).read.schema(stream.schema).parquet(f"{folder}/sink")
