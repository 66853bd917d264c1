"""STR-2: R2 alerts as a change log, so that a late row withdraws the alert that it disproves.

R2 compares a row with the user's previous one. A row that arrives late, between two others, can make a published alert wrong. Every
micro-batch scores anew the places that its rows bear on, (user, bucket of time) of their own and the next bucket, and logs how the
alerts there differ from those that the log held: ``insert`` for a new alert or one with other evidence, ``retract`` for one that
no longer holds. The version is the batch's number; the greatest version of a key is its state. Folded, the log equals the rule
over all accepted rows after any order of arrival.

A batch's changes are its own folder, replaced as a whole by a replay, which reads only the batches before it. Users are carried
as pseudonyms. No task holds more than a user's rows of a bucket, and work follows the batch's places, not the age of the stream.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from txnwatch.config import RuleSet
from txnwatch.functions.masking import pseudonym
from txnwatch.functions.time import epoch_seconds, epoch_seconds_sql
from txnwatch.operators.alerts import alert_key
from txnwatch.operators.rules import check_geo_jump

KEY = ("alert_id", "kafka_partition", "kafka_offset")
EVIDENCE = ("prev_sec", "distance_km", "time_diff_minutes")
LOG_SCHEMA = ("alert_id STRING, kafka_partition INT, kafka_offset BIGINT, op STRING, transaction_id STRING, user_hash STRING, event_sec BIGINT, "
              "prev_sec BIGINT, distance_km DOUBLE, time_diff_minutes DOUBLE, batch_id BIGINT, event_day INT")
_ROW = ("op", "transaction_id", "user_hash", "event_sec", *EVIDENCE)


def folded(log: DataFrame) -> DataFrame:
    """The alerts that hold: for each key its greatest version, unless that is a retraction."""
    newest = log.groupBy(*KEY).agg(F.max_by(F.struct(*_ROW, "batch_id"), "batch_id").alias("s"))
    return newest.where("s.op = 'insert'").select(*KEY, *[f"s.{c}" for c in _ROW if c != "op"], "s.batch_id")


@dataclass
class GeoChangeLog:
    """The change log of R2 below ``root``."""

    root: str
    rules: RuleSet = field(default_factory=RuleSet)

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/geo_changes"

    @property
    def width(self) -> int:
        """Seconds of a bucket: a row's rule never looks back beyond the bucket before its own."""
        return int(float(self.rules.r2.max_interval_minutes) * 60) + 1

    def log(self, spark: SparkSession) -> DataFrame:
        """All changes so far; empty before the first batch."""
        try:
            return spark.read.schema(LOG_SCHEMA).parquet(self.path)
        except AnalysisException:
            return spark.createDataFrame([], LOG_SCHEMA)

    def current(self, spark: SparkSession) -> DataFrame:
        """The alerts that hold after the batches so far."""
        return folded(self.log(spark))

    def advance(self, history: DataFrame, batch: DataFrame, batch_id: int) -> None:
        """Log the changes that ``batch`` brings. ``history`` has all accepted rows up to it, its own included.

        Rows without a user or a time take no part. A batch without rows changes nothing, and a replay none but its own folder.
        """
        spark, w = batch.sparkSession, self.width
        sec = epoch_seconds_sql(batch, "timestamp")
        rows = batch.where("user_id IS NOT NULL AND `timestamp` IS NOT NULL").selectExpr("user_id", f"{sec} AS s", f"floor({sec} / {w}) AS b")
        span = rows.agg(F.min("s").alias("lo"), F.max("s").alias("hi")).first()
        lo, hi = (span["lo"], span["hi"]) if span["lo"] is not None else (0, -1)
        touched = rows.selectExpr("user_id", "explode(array(b, b + 1)) AS b").distinct()
        # The bucket before a place is read for the previous rows, and not scored.
        places = touched.selectExpr("user_id", "b", "explode(array(b - 1, b)) AS __b").groupBy("user_id", "__b").agg(F.max(F.expr("b = __b")).alias("__own"))
        near = history.where(epoch_seconds(history, "timestamp").between(lo - 2 * w, hi + 2 * w)).withColumn("__b", F.expr(f"floor({epoch_seconds_sql(history, 'timestamp')} / {w})"))
        hits = check_geo_jump(near.join(places, ["user_id", "__b"]), self.rules.r2.max_distance_km, self.rules.r2.max_interval_minutes).where("__own")
        after = hits.select(
            alert_key(F.lit("GEO_JUMP")).alias("alert_id"), "kafka_partition", "kafka_offset", "transaction_id",
            pseudonym("user_id", self.rules.salt).alias("user_hash"), epoch_seconds(hits, "timestamp").alias("event_sec"),
            epoch_seconds(hits, "prev_ts").alias("prev_sec"), "distance_km", "time_diff_minutes").dropDuplicates(list(KEY))
        days = F.col("event_day").between(lo // 86400, (hi + 2 * w) // 86400)
        held = folded(self.log(spark).where(days & (F.col("batch_id") < batch_id))).drop("batch_id")
        mine = touched.select(pseudonym("user_id", self.rules.salt).alias("user_hash"), F.col("b").alias("__b"))
        before = held.withColumn("__b", F.expr(f"floor(event_sec / {w})")).join(mine, ["user_hash", "__b"], "left_semi").drop("__b")
        self._changes(before, after).withColumn("event_day", F.expr("CAST(floor(event_sec / 86400) AS INT)")).write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("event_day").parquet(f"{self.path}/batch_id={int(batch_id)}")

    @staticmethod
    def _changes(before: DataFrame, after: DataFrame) -> DataFrame:
        columns = [c for c in _ROW if c != "op"]
        b = before.select(*KEY, F.struct(*columns).alias("b"))
        a = after.select(*KEY, F.struct(*columns).alias("a"))
        both = b.join(a, list(KEY), "full")
        differs = "NOT (" + " AND ".join(f"a.{c} <=> b.{c}" for c in EVIDENCE) + ")"
        changed = both.where(f"a IS NULL OR b IS NULL OR {differs}").withColumn("op", F.expr("CASE WHEN a IS NULL THEN 'retract' ELSE 'insert' END"))
        return changed.select(*KEY, "op", *[F.expr(f"coalesce(a.{c}, b.{c})").alias(c) if c not in EVIDENCE else F.col(f"a.{c}").alias(c) for c in columns])
