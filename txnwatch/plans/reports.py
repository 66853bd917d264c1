"""Alert reports and reconciliation queries (AGG-*, SRT-*, JOIN-4/6/7, SRC-7).

All are plain DataFrame plans over the alert, Bronze and Silver tables; small
fixed lookups (four rules) are broadcast, everything else is left to the
planner and AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from txnwatch.config import RULE_IDS, SEVERITY
from txnwatch.functions.masking import pseudonym
from txnwatch.functions.time import epoch_seconds
from txnwatch.operators.alerts import rule_id
from txnwatch.operators.trailing import spread


#: Where a record came from; unlike a transaction id, unique.
INGEST_KEY = ("kafka_partition", "kafka_offset")


def alerts_by_rule(alerts: DataFrame) -> DataFrame:
    """AGG-6: number of alerts per rule type."""
    return alerts.groupBy("rule_type").agg(F.count(F.lit(1)).alias("alert_count"))


def alert_total(alerts: DataFrame) -> DataFrame:
    """AGG-2/AGG-3: one row, the number of alerts."""
    return alerts.agg(F.count(F.lit(1)).alias("alert_count"))


def distinct_rule_types(alerts: DataFrame) -> DataFrame:
    """AGG-4: the rule types present."""
    return alerts.select("rule_type").distinct()


def latest_alerts(alerts: DataFrame, n: int = 20, order_by: str = "alert_time") -> DataFrame:
    """SRT-2/3: newest ``n`` rows; ties broken by ``alert_id`` so the cut is stable.

    Plans as ``TakeOrderedAndProject``: each task keeps its own top ``n``.
    """
    tiebreak = "alert_id" if "alert_id" in alerts.columns else alerts.columns[0]
    return alerts.orderBy(F.col(order_by).desc(), F.col(tiebreak).desc()).limit(n)


def alerts_since(alerts: DataFrame, cursor, time_col: str = "alert_time") -> DataFrame:
    """SRC-7 / FLT-8 / SRT-1: alerts strictly after ``cursor``, oldest first."""
    c = cursor if isinstance(cursor, Column) else F.lit(cursor)
    return alerts.filter(F.col(time_col) > c).orderBy(time_col, "alert_id")


def next_cursor(alerts: DataFrame, cursor, time_col: str = "alert_time") -> DataFrame:
    """AGG-5: the cursor after reading ``alerts``: max(alert_time), or the old one."""
    c = cursor if isinstance(cursor, Column) else F.lit(cursor)
    return alerts.filter(F.col(time_col) > c).agg(
        F.coalesce(F.max(time_col), c).alias("cursor"))


def severity_table(spark: SparkSession) -> DataFrame:
    """The four-row triage table (rule id, tag, severity, response minutes)."""
    tags = {rid: tag for tag, rid in RULE_IDS.items()}
    rows = [(rid, tags[rid], sev, minutes) for rid, (sev, minutes) in sorted(SEVERITY.items())]
    schema = StructType([
        StructField("rule_id", StringType(), False),
        StructField("rule_type", StringType(), False),
        StructField("severity", StringType(), False),
        StructField("response_minutes", IntegerType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def alerts_with_severity(alerts: DataFrame) -> DataFrame:
    """JOIN-4/PRJ-13: rule id, severity and response time attached to each alert.

    The lookup has exactly four rows, so it is broadcast.
    """
    table = severity_table(alerts.sparkSession).drop("rule_id")
    return (alerts.join(F.broadcast(table), on="rule_type", how="left")
                  .withColumn("rule_id", rule_id()))


def alerts_not_in_bronze(alerts: DataFrame, bronze: DataFrame, on: tuple[str, ...] = ("transaction_id",)) -> DataFrame:
    """JOIN-6: alerts whose transaction is missing from Bronze (expected empty).

    Transaction ids may collide, and a lost row hides behind another of its id: alerts that
    carry the ingest identity are matched ``on=INGEST_KEY``. ``inline`` generates the key, so the anti-join stays above the union of the rules and
    Bronze is read once, not once a rule.
    """
    keyed = alerts.select(F.inline(F.array(F.struct(*alerts.columns))))
    return keyed.join(bronze.select(*on), on=list(on), how="left_anti")


def bronze_silver_reconcile(bronze: DataFrame, silver: DataFrame, salt: str) -> DataFrame:
    """JOIN-7: one row of checks between Bronze and Silver.

    Rows are matched on their ingest identity ``(kafka_partition,
    kafka_offset)``; counts of rows on each side, matches, one-sided rows,
    pseudonyms that do not equal the salted hash, pseudonyms that contain the
    raw id, and whether Silver exposes a device column at all.
    """
    key = ["kafka_partition", "kafka_offset"]
    b = bronze.select(*key, F.col("user_id"), F.lit(1).alias("in_b"))
    s = silver.select(*key, F.col("user_hash"), F.lit(1).alias("in_s"))
    joined = b.join(s, on=key, how="full_outer")
    both = F.col("in_b").isNotNull() & F.col("in_s").isNotNull()
    expected = pseudonym("user_id", salt)
    return joined.agg(
        F.count(F.col("in_b")).alias("bronze_rows"),
        F.count(F.col("in_s")).alias("silver_rows"),
        F.count(F.when(both, 1)).alias("matched_rows"),
        F.count(F.when(F.col("in_s").isNull(), 1)).alias("missing_in_silver"),
        F.count(F.when(F.col("in_b").isNull(), 1)).alias("missing_in_bronze"),
        F.count(F.when(both & ~F.col("user_hash").eqNullSafe(expected), 1)).alias("hash_mismatches"),
        F.count(F.when(both & F.col("user_hash").contains(F.col("user_id")), 1)).alias("id_leaks"),
    ).withColumn("silver_has_device_id", F.lit("device_id" in silver.columns))


def alert_latency(alerts: DataFrame, accuracy: int = 10000) -> DataFrame:
    """AGG-7: per rule, alert time minus event time in whole seconds.

    Percentiles are approximate (bounded memory per group); count, min, max
    and mean are exact.
    """
    lat = (epoch_seconds(alerts, "alert_time") - epoch_seconds(alerts, "timestamp")).alias("lat")
    with_lat = alerts.select("rule_type", lat)
    return with_lat.groupBy("rule_type").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.min("lat").alias("min_latency_s"),
        F.max("lat").alias("max_latency_s"),
        F.avg("lat").alias("avg_latency_s"),
        F.percentile_approx("lat", 0.5, accuracy).alias("p50_latency_s"),
        F.percentile_approx("lat", 0.95, accuracy).alias("p95_latency_s"),
    )


def throughput(txns: DataFrame, ts: str = "timestamp", bucket: str = "1 second") -> DataFrame:
    """AGG-8: rows per event-time bucket -> peak, mean and active buckets."""
    per = txns.groupBy(F.window(ts, bucket).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max("n").alias("peak_per_bucket"),
                   F.avg("n").alias("mean_per_active_bucket"),
                   F.count(F.lit(1)).alias("active_buckets"),
                   F.sum("n").alias("rows"))


def recall_by_rule(expected: DataFrame, alerts: DataFrame) -> DataFrame:
    """AGG-9: share of expected ``(transaction_id, rule_type)`` hits that alerted.

    Both sides meet in one grouping, in partitions that grow in number and not in size; an id or rule that is null is
    expected and never found.
    """
    keys = ["transaction_id", "rule_type"]
    sides = expected.selectExpr(*keys, "true AS e", "false AS h").union(
        alerts.selectExpr(*keys, "false AS e", "transaction_id IS NOT NULL AND rule_type IS NOT NULL AS h"))
    each = spread(sides, keys, source=alerts).groupBy(*keys).agg(F.max("e").alias("e"), F.max("h").alias("h")).where("e")
    return each.groupBy("rule_type").agg(
        F.count(F.lit(1)).alias("expected"),
        F.count_if("h").alias("found"),
        (F.count_if("h") / F.count(F.lit(1))).alias("recall"))


def newest_rows(table: DataFrame, n: int = 3, order_by: str = "ingest_time",
                columns: list[str] | None = None) -> DataFrame:
    """SRT-3 / PRJ-14: the newest ``n`` rows of Bronze or Silver (by ingest time,
    ties by ingest identity), optionally as an analyst column subset."""
    cols = columns or table.columns
    tie = [c for c in ("kafka_partition", "kafka_offset") if c in table.columns]
    order = [F.col(order_by).desc(), *[F.col(c).desc() for c in tie]]
    return table.orderBy(*order).limit(n).select(*cols)


def sample_rows(table: DataFrame, k: int = 5) -> DataFrame:
    """SRT-4: any ``k`` rows, no order (a peek; plans as a local+global limit)."""
    return table.limit(k)
