"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads the whole ``events`` table through the transaction view and runs
one operator (or a composition) of the inventory.  Output columns are named
exactly as in the SQL oracle (``txnwatch.plans.oracle``).  Timestamps leave
as ``TIMESTAMP_NTZ`` (wall clock in UTC) so they compare zone-free.

``WIDE`` loosens the thresholds so every rule fires on the synthetic data
(with the defaults R1 and R4 never do); both settings are registered.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.config import TAG_MERCHANT_VELOCITY, TAG_NIGHT_LARGE, TAG_VELOCITY, RuleSet
from txnwatch.operators import quantiles, registry
from txnwatch.operators import rules as R
from txnwatch.operators.alerts import explode_detail, to_alerts
from txnwatch.operators.bloom import screen_large
from txnwatch.operators.interval_join import geo_pairs
from txnwatch.operators.registry import CountRule, RowRule
from txnwatch.operators.screening import screen
from txnwatch.operators.sketches import trailing_distinct_sketch
from txnwatch.operators.windows import window_alerts, window_counts
from txnwatch.plans import feed, reports, stream_catalog
from txnwatch.plans.medallion import bronze, silver
from txnwatch.session import pin_utc
from txnwatch.sources.events import TXN_COLUMNS, load_transactions
from txnwatch.sources.wire import parse_wire, split_valid, to_envelope

DEFAULT = RuleSet()
WIDE = DEFAULT.replace(
    r1=dict(window_minutes=60, threshold=1),
    r2=dict(max_interval_minutes=60),
    r3=dict(min_amount=1000),
    r4=dict(window_minutes=30, threshold=3),
)
# Cursor used by the incremental-read queries (a parameter, not a filter on ids).
CURSOR = "2024-01-29 00:00:00"
TRIGGER_SECONDS = 5

Query = Callable[[SparkSession, str], DataFrame]


def _tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return load_transactions(spark, sf_dir)


def _hits_out(df: DataFrame, evidence: list[str]) -> DataFrame:
    cols = [*TXN_COLUMNS, "user_hash", *evidence]
    out = df.select(*cols)
    if "distance_km" in evidence:
        out = out.withColumn("distance_km", F.round("distance_km", 6))
    return out


def _with_hash(df: DataFrame, rules: RuleSet = DEFAULT) -> DataFrame:
    from txnwatch.functions.masking import pseudonym

    return df.withColumn("user_hash", pseudonym("user_id", rules.salt))


def _rule(fn, evidence: list[str]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _hits_out(_with_hash(fn(_tx(spark, sf_dir))), evidence)
    return run


def _all_rules(rules: RuleSet) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        hits = R.apply_all_rules(_tx(spark, sf_dir), rules)
        return hits.withColumn("distance_km", F.round("distance_km", 6))
    return run


def batch_alert_time() -> F.Column:
    """Deterministic alert time for batch replays: the close of the
    ``TRIGGER_SECONDS`` micro-batch that would have held the event."""
    sec = F.unix_seconds(F.col("timestamp").cast("timestamp"))
    return F.timestamp_seconds(F.floor(sec / TRIGGER_SECONDS) * TRIGGER_SECONDS + TRIGGER_SECONDS)


def wide_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = R.apply_all_rules(_tx(spark, sf_dir), WIDE)
    return to_alerts(hits, WIDE, alert_time=batch_alert_time())


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def q_transactions(spark, sf_dir):
    return _tx(spark, sf_dir)


def q_parse_flatten(spark, sf_dir):
    parsed = parse_wire(to_envelope(_tx(spark, sf_dir)))
    valid, _ = split_valid(parsed)
    return _ntz(valid, "timestamp")


def q_bronze(spark, sf_dir):
    return bronze(_tx(spark, sf_dir)).drop("ingest_time")


def q_silver(spark, sf_dir):
    return silver(bronze(_tx(spark, sf_dir)), DEFAULT.salt).drop("ingest_time")


def q_distinct_users(spark, sf_dir):
    hits = _with_hash(R.check_merchant_distinct_users(_tx(spark, sf_dir), 30, 3))
    return _hits_out(hits, ["merchant_user_count"])


def q_alerts(spark, sf_dir):
    alerts = explode_detail(wide_alerts(spark, sf_dir))
    return alerts.drop("trigger_detail", "alert_time")


def q_alerts_by_rule(spark, sf_dir):
    return reports.alerts_by_rule(wide_alerts(spark, sf_dir))


def q_alert_total(spark, sf_dir):
    return reports.alert_total(wide_alerts(spark, sf_dir))


def q_distinct_rule_types(spark, sf_dir):
    return reports.distinct_rule_types(wide_alerts(spark, sf_dir))


def q_latest_alerts(spark, sf_dir):
    top = reports.latest_alerts(wide_alerts(spark, sf_dir), n=20, order_by="timestamp")
    return top.select("alert_id", "rule_type", "transaction_id", "user_hash", "amount", "timestamp")


def q_alerts_since(spark, sf_dir):
    cursor = F.lit(CURSOR).cast("timestamp")
    since = reports.alerts_since(wide_alerts(spark, sf_dir), cursor)
    return _ntz(since.select("alert_id", "rule_type", "transaction_id", "timestamp", "alert_time"),
                "alert_time")


def q_next_cursor(spark, sf_dir):
    cursor = F.lit(CURSOR).cast("timestamp")
    return _ntz(reports.next_cursor(wide_alerts(spark, sf_dir), cursor), "cursor")


#: Broker offsets of a micro-batch, and the place that the sequence queries read on from: amid a batch.
BATCH_OFFSETS = 500
PLACE = feed.Place(3, 7)


def _published(spark, sf_dir):
    """Alerts with the micro-batch that would have published them."""
    hits = R.apply_all_rules(_tx(spark, sf_dir), WIDE)
    alerts = to_alerts(hits, WIDE, alert_time=batch_alert_time(), keep=("kafka_partition", "kafka_offset"))
    return alerts.withColumn("batch_id", F.expr(f"kafka_offset div {BATCH_OFFSETS}"))


def q_alerts_after_place(spark, sf_dir):
    return feed.after(_published(spark, sf_dir), PLACE).select("batch_id", "position", "alert_id", "kafka_partition", "kafka_offset")


def q_next_place(spark, sf_dir):
    return feed.next_place(feed.after(_published(spark, sf_dir), PLACE), PLACE)


def q_alerts_with_severity(spark, sf_dir):
    out = reports.alerts_with_severity(wide_alerts(spark, sf_dir))
    return out.select("alert_id", "rule_type", "rule_id", "severity", "response_minutes")


def q_alerts_not_in_bronze(spark, sf_dir):
    b = bronze(_tx(spark, sf_dir))
    missing = reports.alerts_not_in_bronze(wide_alerts(spark, sf_dir), b)
    return missing.select("alert_id", "rule_type", "transaction_id")


def q_reconcile(spark, sf_dir):
    b = bronze(_tx(spark, sf_dir))
    return reports.bronze_silver_reconcile(b, silver(b, DEFAULT.salt), DEFAULT.salt)


def q_alert_latency(spark, sf_dir):
    return reports.alert_latency(wide_alerts(spark, sf_dir))


def q_throughput(spark, sf_dir):
    return reports.throughput(_tx(spark, sf_dir))


def q_recall(spark, sf_dir):
    # expected hits from the separate per-rule operators, checked against the
    # alerts of the fused path (both bucketed, so both scale on hot keys)
    tx = _tx(spark, sf_dir)
    expected = R.apply_all_rules(tx, WIDE, fuse_user_rules=False)
    return reports.recall_by_rule(expected, wide_alerts(spark, sf_dir))


def _blacklist(spark, sf_dir, keep):
    tx = _tx(spark, sf_dir)
    listed = R.check_night_large(tx, 1000, 0, 5).select("user_id")
    out = screen(tx, listed, "user_id", keep=keep)
    return out.select("transaction_id", "user_id", "merchant_id", "amount", "timestamp")


def _windows(key, duration, slide, out="txn_count", threshold=None):
    def run(spark, sf_dir):
        counts = window_counts(_tx(spark, sf_dir), key, duration, slide, out=out)
        if threshold is not None:
            counts = window_alerts(counts, threshold, out=out)
        return counts
    return run


def q_newest_silver(spark, sf_dir):
    # one ingest stamp per query: the newest rows are decided by ingest identity
    s = silver(bronze(_tx(spark, sf_dir)), DEFAULT.salt)
    return reports.newest_rows(s, 3, columns=["transaction_id", "user_hash", "merchant_id",
                                              "amount", "ip_mask", "kafka_partition",
                                              "kafka_offset"])


def q_newest_bronze(spark, sf_dir):
    return reports.newest_rows(bronze(_tx(spark, sf_dir)), 3, columns=["transaction_id", "user_id", "merchant_id", "amount", "ip_address",
                                                                       "device_id", "kafka_partition", "kafka_offset"])


def q_rejects(spark, sf_dir):
    """The rejects when every tenth record is no JSON, the next has no readable time, the next no user."""
    sent = to_envelope(_tx(spark, sf_dir)).withColumn("value", F.expr(r"""
        CASE offset % 10 WHEN 1 THEN concat('#', value)
                         WHEN 2 THEN regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":"noon"')
                         WHEN 3 THEN replace(value, '"user_id":', '"uid":') ELSE value END"""))
    _, rejects = split_valid(parse_wire(sent))
    return _ntz(rejects, "timestamp").select("kafka_partition", "kafka_offset", "transaction_id", "user_id", "amount", "timestamp")


def q_blacklist_merchant(spark, sf_dir):
    listed = spark.createDataFrame([("M3002",)], "merchant_id string")
    out = screen(_tx(spark, sf_dir), listed, "merchant_id", keep="hits")
    return out.select("transaction_id", "user_id", "merchant_id", "amount", "timestamp")


def q_blacklist_ip(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    out = screen(tx, R.check_night_large(tx, 1500, 0, 5).select("ip_address"), "ip_address", keep="hits")
    return out.select("transaction_id", "ip_address", "amount", "timestamp")


def q_recall_by_label(spark, sf_dir):
    """Recall against labels stated from the data alone: large amounts before six o'clock, and the newest of a user's
    several transactions in one hour of the clock. The night rule ends at five, so it misses some."""
    tx = _tx(spark, sf_dir)
    night = tx.where("amount > 1000 AND hour(timestamp) < 6").selectExpr("transaction_id", "'NIGHT_LARGE' AS rule_type")
    newest = F.max(F.struct("timestamp", "transaction_id")).alias("newest")
    busy = tx.groupBy("user_id", F.date_trunc("hour", "timestamp").alias("h")).agg(F.count("*").alias("n"), newest)
    busy = busy.where("n > 1").selectExpr("newest.transaction_id", "'VELOCITY_FRAUD' AS rule_type")
    return reports.recall_by_rule(night.unionByName(busy), wide_alerts(spark, sf_dir))


def q_alerts_in_lost_hour(spark, sf_dir):
    """Alerts without their transaction when Bronze lacks an hour of the day."""
    kept = bronze(_tx(spark, sf_dir)).where("hour(timestamp) <> 3")
    return reports.alerts_not_in_bronze(wide_alerts(spark, sf_dir), kept).select("alert_id", "rule_type", "transaction_id")


def q_bronze_silver_gaps(spark, sf_dir):
    """Reconciliation when each table lacks another hour of the day."""
    b = bronze(_tx(spark, sf_dir))
    return reports.bronze_silver_reconcile(b.where("hour(timestamp) <> 3"), silver(b, DEFAULT.salt).where("hour(timestamp) <> 4"), DEFAULT.salt)


#: Five rules over three keys; the two of an account and the one of a device are the registry's own.
REGISTRY = (
    CountRule(TAG_VELOCITY, "user_id", 60, 1),
    CountRule("DAILY_VELOCITY", "user_id", 1440, 3),
    RowRule(TAG_NIGHT_LARGE, "amount > 1000.0D AND hour(timestamp) < 5"),
    CountRule(TAG_MERCHANT_VELOCITY, "merchant_id", 30, 3),
    CountRule("DEVICE_VELOCITY", "device_id", 120, 2),
)


def q_distinct_users_sketch(spark, sf_dir):
    """RUL-6 from sketches: accounts at a merchant in the last six buckets of ten minutes, where there are more than two."""
    counts = trailing_distinct_sketch(_tx(spark, sf_dir), "merchant_id", "user_id", "timestamp", 600, 6, "merchant_user_count")
    return counts.where("merchant_user_count > 2")


def _blacklist_bloom(spark, sf_dir, keep):
    """Screening by address, the list treated as one over the broadcast bound."""
    tx = _tx(spark, sf_dir)
    listed = R.check_night_large(tx, 1500, 0, 5).select("ip_address")
    return screen_large(tx, listed, "ip_address", keep=keep).select("transaction_id", "ip_address", "amount", "timestamp")


def q_latency_sketch(spark, sf_dir):
    """Quantiles in microseconds from one sketch for each micro-batch and rule, merged by rule."""
    late = _published(spark, sf_dir).selectExpr("batch_id", "rule_type", "unix_micros(alert_time) - unix_micros(CAST(`timestamp` AS TIMESTAMP)) AS micros")
    sketches = quantiles.histogram(late, ["batch_id", "rule_type"], "micros")
    return quantiles.quantiles(quantiles.merged(sketches, ["rule_type"]), ["rule_type"], {"p50_micros": 0.5, "p95_micros": 0.95, "p99_micros": 0.99})


def q_alert_windows(spark, sf_dir):
    """STR-5: the window that an alert of a counting rule names."""
    detail = F.from_json("trigger_detail", "window_start string, window_end string").alias("w")
    return wide_alerts(spark, sf_dir).select("alert_id", detail).where("w.window_end IS NOT NULL").select("alert_id", "w.*")


def q_lost_colliding(spark, sf_dir):
    """Alerts without their transaction when Bronze lacks an hour and a thousand transactions share each id."""
    tx = _tx(spark, sf_dir).withColumn("transaction_id", F.expr("concat('TXN-', kafka_offset div 1000)"))
    alerts = to_alerts(R.apply_all_rules(tx, WIDE), WIDE, alert_time=batch_alert_time(), keep=reports.INGEST_KEY)
    kept = bronze(tx).where("hour(timestamp) <> 3")
    return reports.alerts_not_in_bronze(alerts, kept, on=reports.INGEST_KEY).select("rule_type", "transaction_id", *reports.INGEST_KEY)


def q_registry(spark, sf_dir):
    return registry.score(_tx(spark, sf_dir), REGISTRY)


def q_interval_pairs(spark, sf_dir):
    return geo_pairs(_tx(spark, sf_dir), max_gap_seconds=600, min_distance_km=1000)


def queries() -> dict[str, Query]:
    d = DEFAULT
    return {
        "transactions": q_transactions,
        "parse_flatten": q_parse_flatten,
        "bronze_projection": q_bronze,
        "silver_projection": q_silver,
        "r1_velocity": _rule(lambda t: R.check_velocity(t, d.r1.window_minutes, d.r1.threshold),
                             ["txn_count"]),
        "r1_velocity_60m": _rule(lambda t: R.check_velocity(t, 60, 1), ["txn_count"]),
        "r1_velocity_720m": _rule(lambda t: R.check_velocity(t, 720, 5), ["txn_count"]),
        "r2_geo_jump": _rule(lambda t: R.check_geo_jump(t, d.r2.max_distance_km,
                                                        d.r2.max_interval_minutes),
                             ["prev_lat", "prev_lon", "prev_ts", "distance_km", "time_diff_minutes"]),
        "r2_geo_jump_60m": _rule(lambda t: R.check_geo_jump(t, 1000, 60),
                                 ["prev_lat", "prev_lon", "prev_ts", "distance_km",
                                  "time_diff_minutes"]),
        "r3_night_large": _rule(lambda t: R.check_night_large(t, d.r3.min_amount, d.r3.start_hour,
                                                              d.r3.end_hour), []),
        "r3_night_large_1000": _rule(lambda t: R.check_night_large(t, 1000, 0, 5), []),
        "r4_merchant_velocity": _rule(lambda t: R.check_merchant_velocity(
            t, d.r4.window_minutes, d.r4.threshold), ["merchant_txn_count"]),
        "r4_merchant_velocity_30m": _rule(lambda t: R.check_merchant_velocity(t, 30, 3),
                                          ["merchant_txn_count"]),
        "r4_distinct_users_30m": q_distinct_users,
        "all_rules": _all_rules(DEFAULT),
        "all_rules_wide": _all_rules(WIDE),
        "alerts": q_alerts,
        "alerts_by_rule": q_alerts_by_rule,
        "alert_total": q_alert_total,
        "distinct_rule_types": q_distinct_rule_types,
        "latest_alerts": q_latest_alerts,
        "alerts_since_cursor": q_alerts_since,
        "next_cursor": q_next_cursor,
        "alerts_after_place": q_alerts_after_place,
        "next_place": q_next_place,
        "alerts_with_severity": q_alerts_with_severity,
        "alerts_not_in_bronze": q_alerts_not_in_bronze,
        "bronze_silver_reconcile": q_reconcile,
        "alert_latency": q_alert_latency,
        "throughput": q_throughput,
        "recall_by_rule": q_recall,
        "blacklist_hits": lambda s, d_: _blacklist(s, d_, "hits"),
        "blacklist_pass": lambda s, d_: _blacklist(s, d_, "pass"),
        "tumbling_user_counts": _windows("user_id", "5 minutes", None),
        "sliding_user_counts": _windows("user_id", "5 minutes", "1 minute"),
        "sliding_merchant_counts": _windows("merchant_id", "1 minute", "10 seconds",
                                            out="merchant_txn_count"),
        "sliding_user_alerts": _windows("user_id", "60 minutes", "15 minutes", threshold=2),
        "interval_pairs": q_interval_pairs,
        "r1_velocity_720m_prefix": _rule(lambda t: R.check_velocity(t, 720, 5, strategy="prefix"), ["txn_count"]),
        "r4_merchant_velocity_30m_prefix": _rule(lambda t: R.check_merchant_velocity(t, 30, 3, strategy="prefix"), ["merchant_txn_count"]),
        "registry_rules": q_registry,
        "r4_distinct_users_sketch": q_distinct_users_sketch,
        "newest_silver_rows": q_newest_silver,
        "newest_bronze_rows": q_newest_bronze,
        "all_rules_r3_only": _all_rules(WIDE.replace(r1=dict(enabled=False), r2=dict(enabled=False), r4=dict(enabled=False))),
        "all_rules_off": _all_rules(WIDE.replace(r1=dict(enabled=False), r2=dict(enabled=False), r3=dict(enabled=False),
                                                 r4=dict(enabled=False))),
        "rejects": q_rejects,
        "blacklist_merchant_hits": q_blacklist_merchant,
        "blacklist_ip_hits": q_blacklist_ip,
        "recall_by_label": q_recall_by_label,
        "alerts_in_lost_hour": q_alerts_in_lost_hour,
        "bronze_silver_gaps": q_bronze_silver_gaps,
        "blacklist_bloom_hits": lambda s, d_: _blacklist_bloom(s, d_, "hits"),
        "blacklist_bloom_pass": lambda s, d_: _blacklist_bloom(s, d_, "pass"),
        "alert_latency_sketch": q_latency_sketch,
        "alert_windows": q_alert_windows,
        "alerts_lost_colliding": q_lost_colliding,
        **stream_catalog.queries(WIDE),
    }
