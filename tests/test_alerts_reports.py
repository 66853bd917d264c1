"""Alert projection (PRJ-10..13, SNK-5) and the report queries."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from txnwatch.config import RuleSet
from txnwatch.operators.alerts import explode_detail, rule_id, to_alerts
from txnwatch.operators.rules import apply_all_rules
from txnwatch.operators.screening import screen
from txnwatch.plans import reports
from txnwatch.plans.medallion import bronze, silver
from txnwatch.schemas import ALERT_COLUMNS

from helpers import frame, minutes, txn


def _alerts(spark):
    base = datetime(2024, 1, 15, 3)
    df = frame(spark, [txn(f"T{i}", base + minutes(i), amount=6000 + i) for i in range(6)])
    return to_alerts(apply_all_rules(df), RuleSet())


def test_alert_shape_key_and_detail(spark):
    alerts = _alerts(spark)
    assert tuple(alerts.columns) == ALERT_COLUMNS
    rows = {r.alert_id: r for r in alerts.collect()}
    assert "ALERT-VELOCITY_FRAUD-T5" in rows and "ALERT-NIGHT_LARGE-T0" in rows
    v = json.loads(rows["ALERT-VELOCITY_FRAUD-T5"].trigger_detail)
    assert v["txn_count"] == 6 and v["threshold"] == 5 and v["window_minutes"] == 5
    assert v["rule"].startswith("R1: ") and "U1001" not in json.dumps(v)
    assert v["user_hash"] == rows["ALERT-VELOCITY_FRAUD-T5"].user_hash
    n = json.loads(rows["ALERT-NIGHT_LARGE-T0"].trigger_detail)
    assert n["amount"] == 6000.0 and n["min_amount"] == 5000 and "txn_count" not in n
    assert all(r.alert_time is not None for r in rows.values())


def test_detail_round_trip_and_rule_id(spark):
    out = explode_detail(_alerts(spark)).withColumn("rid", rule_id())
    got = {(r.rule_type, r.rid) for r in out.collect()}
    assert got == {("NIGHT_LARGE", "R3"), ("VELOCITY_FRAUD", "R1")}


def test_reports(spark):
    alerts = _alerts(spark)
    by_rule = {r.rule_type: r.alert_count for r in reports.alerts_by_rule(alerts).collect()}
    assert by_rule == {"NIGHT_LARGE": 6, "VELOCITY_FRAUD": 1}
    assert reports.alert_total(alerts).first().alert_count == 7
    top = reports.latest_alerts(alerts, n=2, order_by="timestamp").collect()
    assert [r.alert_id for r in top] == ["ALERT-VELOCITY_FRAUD-T5", "ALERT-NIGHT_LARGE-T5"]
    sev = {r.rule_type: (r.rule_id, r.severity, r.response_minutes)
           for r in reports.alerts_with_severity(alerts).collect()}
    assert sev["VELOCITY_FRAUD"] == ("R1", "high", 5) and sev["NIGHT_LARGE"] == ("R3", "medium", 60)


def test_cursor_reads(spark):
    alerts = _alerts(spark).withColumn("alert_time", F.col("timestamp").cast("timestamp"))
    cursor = F.lit("2024-01-15 03:03:00").cast("timestamp")
    since = reports.alerts_since(alerts, cursor).collect()
    assert [r.transaction_id for r in since] == ["T4", "T5", "T5"]
    nxt = reports.next_cursor(alerts, cursor).first().cursor
    assert nxt == datetime(2024, 1, 15, 3, 5)
    later = F.lit("2030-01-01 00:00:00").cast("timestamp")
    assert reports.next_cursor(alerts, later).first().cursor == datetime(2030, 1, 1)


def test_reconcile_and_not_in_bronze(spark):
    base = datetime(2024, 1, 15, 3)
    df = frame(spark, [txn(f"T{i}", base + minutes(i), amount=6000) for i in range(3)])
    df = df.withColumns({"currency": F.lit("USD"), "city": F.lit("X"),
                         "kafka_partition": F.lit(0), "kafka_offset": F.col("amount").cast("long")
                         + F.monotonically_increasing_id()})
    b = bronze(df)
    s = silver(b, "salt")
    rec = reports.bronze_silver_reconcile(b, s.limit(2), "salt").first()
    assert (rec.bronze_rows, rec.silver_rows, rec.matched_rows, rec.missing_in_silver,
            rec.hash_mismatches, rec.id_leaks, rec.silver_has_device_id) == (3, 2, 2, 1, 0, 0, False)
    alerts = to_alerts(apply_all_rules(df), RuleSet())
    assert reports.alerts_not_in_bronze(alerts, b).count() == 0
    assert reports.alerts_not_in_bronze(alerts, b.filter("transaction_id != 'T1'")).count() == 1


def test_latency_throughput_recall(spark):
    alerts = _alerts(spark).withColumn(
        "alert_time", (F.col("timestamp").cast("long") + 3).cast("timestamp"))
    lat = {r.rule_type: (r.min_latency_s, r.max_latency_s, r.p50_latency_s)
           for r in reports.alert_latency(alerts).collect()}
    assert lat["NIGHT_LARGE"] == (3, 3, 3)
    base = datetime(2024, 1, 15, 3)
    df = frame(spark, [txn(f"T{i}", base, amount=1) for i in range(4)] + [txn("Z", base + minutes(1))])
    tp = reports.throughput(df).first()
    assert (tp.peak_per_bucket, tp.active_buckets, tp.rows) == (4, 2, 5)
    expected = alerts.select("transaction_id", "rule_type")
    rec = {r.rule_type: r.recall for r in reports.recall_by_rule(expected, alerts.limit(0)).collect()}
    assert rec == {"NIGHT_LARGE": 0.0, "VELOCITY_FRAUD": 0.0}


def test_blacklist_screen(spark):
    base = datetime(2024, 1, 15, 3)
    df = frame(spark, [txn("A", base, user="U1"), txn("B", base, user="U2"), txn("C", base, user=None)])
    bl = spark.createDataFrame([("U1",), ("U1",), (None,)], "user_id string")
    assert [r.transaction_id for r in screen(df, bl, "user_id", "hits").collect()] == ["A"]
    assert sorted(r.transaction_id for r in screen(df, bl, "user_id", "pass").collect()) == ["B", "C"]


def test_newest_and_sample_rows(spark):
    base = datetime(2024, 1, 15, 3)
    df = frame(spark, [txn(f"T{i}", base + minutes(i)) for i in range(5)])
    df = df.withColumns({"ingest_time": F.col("timestamp"), "kafka_partition": F.lit(0),
                         "kafka_offset": F.lit(1)})
    top = reports.newest_rows(df, 3, columns=["transaction_id", "amount"]).collect()
    assert [r.transaction_id for r in top] == ["T4", "T3", "T2"]
    assert reports.sample_rows(df, 2).count() == 2


def test_recall_groups_once_and_finds_no_null_key(spark):
    """Null ids and rules are expected and never found, repeated hits count once, and no join sorts both sides."""
    from txnwatch.plans.reports import recall_by_rule

    rows = [("T1", "A"), ("T1", "A"), ("T2", "A"), (None, "A"), ("T3", None), ("T4", "B")]
    expected = spark.createDataFrame(rows, "transaction_id string, rule_type string")
    got = recall_by_rule(expected, spark.createDataFrame([("T1", "A"), ("T1", "A"), (None, "A"), ("T3", None), ("T9", "C")], expected.schema))
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.rule_type, r.expected, r.found, round(r.recall, 4)) for r in got.collect()} == {("A", 3, 1, 0.3333), (None, 1, 0, 0.0), ("B", 1, 0, 0.0)}
