"""SRC-7 / SRC-8 / AGG-5 by commit sequence: an alert is read once, whenever it was stamped and however often one polls.

A clock is no cursor: a batch that is published late under an earlier stamp is never after the last time read, and the alerts
of a batch share one stamp, so a page that ends inside it loses the rest. A cursor here is a place ``(batch_id, position)``:
batches of a stream are published one after another, a batch counts from the moment its log entry is written (the last of
its writes), and position numbers its alerts by alert id and place in the broker, which a replay does not change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from txnwatch.operators.trailing import spread
from txnwatch.streaming.job import TABLE_SCHEMAS, read_table

_WITHIN = ("alert_id", "kafka_partition", "kafka_offset")


@dataclass(frozen=True, order=True)
class Place:
    """The last alert read; nothing yet at first."""

    batch_id: int = -1
    position: int = 0


def numbered(alerts: DataFrame) -> DataFrame:
    """``alerts`` (with batch_id and the alerts' place in the broker) with ``position``, from 1 in each batch.

    A window partition is one micro-batch's alerts, which the trigger's limits bound.
    """
    order = [F.col(c).asc_nulls_first() for c in _WITHIN]
    return alerts.withColumn("position", F.row_number().over(Window.partitionBy("batch_id").orderBy(*order)))


def after(alerts: DataFrame, place: Place, limit: int | None = None) -> DataFrame:
    """Alerts beyond ``place`` in order, at most ``limit``; whole batches before it are pruned by batch_id."""
    rest = alerts.where(F.col("batch_id") >= place.batch_id)
    # All that is left goes into tasks of bounded size; a page's poll reads few batches of what may be a large table.
    rest = numbered(rest if limit else spread(rest, ["batch_id"]))
    rest = rest.where((F.col("batch_id") > place.batch_id) | (F.col("position") > place.position)).orderBy("batch_id", "position")
    return rest.limit(limit) if limit else rest


def next_place(read: DataFrame, place: Place) -> DataFrame:
    """One row, batch_id and position: where reading goes on after ``read``, which began at ``place``."""
    last = read.agg(F.max(F.struct("batch_id", F.col("position").cast("long").alias("position"))).alias("p"))
    return last.select(F.coalesce("p.batch_id", F.lit(place.batch_id).cast("long")).alias("batch_id"), F.coalesce("p.position", F.lit(place.position).cast("long")).alias("position"))


def committed(spark: SparkSession, root: str, since: Place) -> DataFrame:
    """Alerts of a job's completed batches from ``since``'s on: none of a batch that is being written."""
    empty = spark.createDataFrame([], TABLE_SCHEMAS["alerts"])
    try:
        top = read_table(spark, root, "_batches").agg(F.max("batch_id")).first()[0]
        alerts = read_table(spark, root, "alerts")
    except AnalysisException:
        return empty
    return empty if top is None else alerts.where(F.col("batch_id").between(since.batch_id, top))


class AlertReader:
    """Polls a job's alerts; every alert comes in exactly one poll."""

    def __init__(self, spark: SparkSession, root: str, place: Place = Place()):
        self.spark, self.root, self.place = spark, root, place

    def poll(self, limit: int) -> list:
        """The next alerts, at most ``limit``; ``place`` then says where to go on, also for another reader."""
        rows = after(committed(self.spark, self.root, self.place), self.place, limit).collect()
        if rows:
            self.place = Place(rows[-1]["batch_id"], rows[-1]["position"])
        return rows
