"""Configuration, session helpers and the physical-plan properties relied on."""

import os

from pyspark.sql import functions as F

from txnwatch.config import RuleSet, load_rules
from txnwatch.operators.rules import apply_all_rules, check_night_large, check_velocity
from txnwatch.operators.screening import screen
from txnwatch.session import checkpoint_dir
from txnwatch.sources.events import load_transactions

from helpers import ROOT, SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_yaml_rules_load_and_override():
    rules = load_rules(os.path.join(ROOT, "conf", "rules.yaml"))
    assert (rules.r1.window_minutes, rules.r1.threshold) == (5, 5)
    assert (rules.r2.max_distance_km, rules.r2.max_interval_minutes) == (1000, 10)
    assert (rules.r3.min_amount, rules.r3.start_hour, rules.r3.end_hour) == (5000, 0, 5)
    assert (rules.r4.window_minutes, rules.r4.threshold) == (1, 3)
    assert rules.r1.description.startswith("more than 5")
    wider = RuleSet().replace(r1=dict(window_minutes=60, threshold=1))
    assert wider.r1.description == "more than 1 transactions by one user within 60 minutes"


def test_checkpoint_dir_prefers_the_session_setting(spark):
    current = checkpoint_dir(spark, fallback="/tmp/should-not-be-used")
    assert current and "should-not-be-used" not in current


def test_scan_adds_no_shuffle(spark):
    assert "Exchange" not in _plan(load_transactions(spark, SF001))


def test_bucketed_rule_shuffles_on_key_and_bucket(spark):
    plan = _plan(check_velocity(load_transactions(spark, SF001), 5, 5))
    assert "hashpartitioning(user_id" in plan and "__bkt" in plan
    plain = _plan(check_velocity(load_transactions(spark, SF001), 5, 5, strategy="window"))
    assert "__bkt" not in plain


def test_night_rule_filters_at_the_scan_and_prunes_columns(spark):
    df = check_night_large(load_transactions(spark, SF001)).select("transaction_id", "amount")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(value), IsNotNull(ts)]" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan


def test_alert_columns_pruned_through_rule_windows(spark):
    hits = apply_all_rules(load_transactions(spark, SF001), RuleSet())
    plan = _plan(hits.select("transaction_id", "rule_type"))
    assert "device_id" not in plan and "ip_address" not in plan and "sha2" not in plan


def test_blacklist_plan_is_left_to_measured_bytes(spark):
    tx = load_transactions(spark, SF001)
    listed = tx.select("user_id").distinct()
    assert "GlobalLimit" not in _plan(screen(tx, listed, "user_id", "hits"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = _plan(screen(tx, listed, "user_id", "hits"))
        assert "BroadcastExchange" not in big
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_rejects_keep_the_raw_payload(spark, scratch):
    from txnwatch.schemas import ENVELOPE
    from txnwatch.streaming import StreamJob, read_table

    raw = spark.createDataFrame([("{broken", 0, 1)], ENVELOPE)
    StreamJob(scratch).process_batch(raw, 0)
    rows = read_table(spark, scratch, "rejects").collect()
    assert [(r.json_str, r.kafka_offset) for r in rows] == [("{broken", 1)]


def test_sizing_for_large_and_small_inputs():
    from txnwatch.session import sizing_conf

    big = sizing_conf(100 * 2**40, total_cores=8000)            # 100 TB, 1000 x 8 cores
    assert int(big["spark.sql.shuffle.partitions"]) >= 100 * 2**40 // (256 * 2**20)
    assert int(big["spark.sql.shuffle.partitions"]) % 8000 == 0
    small = sizing_conf(2 * 2**20, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_all_rules_uses_one_exchange_per_key(spark):
    import re

    plan = _plan(apply_all_rules(load_transactions(spark, SF001), RuleSet()))
    keyed = re.findall(r"hashpartitioning\((\w+)#\d+L?, __bkt", plan)
    assert sorted(keyed) == ["merchant_id", "user_id"]
    separate = _plan(apply_all_rules(load_transactions(spark, SF001), RuleSet(),
                                     fuse_user_rules=False))
    assert sorted(re.findall(r"hashpartitioning\((\w+)#\d+L?, __bkt", separate)) == [
        "merchant_id", "user_id", "user_id"]


def test_exchanges_of_the_rules_grow_with_the_input_and_are_not_merged(spark, tmp_path, monkeypatch):
    """A task sorts what SPREAD_BYTES of files hold, not a core's share of the table; the rows stay the same."""
    from txnwatch.operators import trailing
    from txnwatch.plans import catalog

    spark.range(3000).selectExpr("id AS event_id", "timestampadd(SECOND, CAST(id * 40 AS INT), timestamp_ntz'2024-01-01 00:00:00') AS ts", "id % 11 AS user_id",
                                 "'view' AS event_type", "CAST(id % 90 AS DOUBLE) AS value", "concat('{\"k\": ', id % 7, '}') AS props").write.parquet(f"{tmp_path}/events.parquet")
    names = ("all_rules_wide", "r1_velocity_60m", "r2_geo_jump_60m", "r4_distinct_users_30m", "r1_velocity_720m_prefix", "recall_by_rule")
    assert "REPARTITION_BY_NUM" not in catalog.wide_alerts(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    plain = {n: sorted(map(str, catalog.queries()[n](spark, str(tmp_path)).collect())) for n in names}
    monkeypatch.setattr(trailing, "SPREAD_BYTES", 500)
    for n in names:
        df = catalog.queries()[n](spark, str(tmp_path))
        assert "REPARTITION_BY_NUM" in df._jdf.queryExecution().executedPlan().toString(), n
        assert sorted(map(str, df.collect())) == plain[n] and plain[n], n
    assert trailing._read_bytes(spark.range(5).toDF("a")) < 1000  # and nothing where the source tells no size
    assert trailing._read_bytes(spark.createDataFrame([(1,)], "a int").rdd.toDF()) == 0


def test_exchanges_of_large_inputs_stay_below_the_sort_shuffle(spark, monkeypatch):
    """Beyond 200 partitions a map task sorts all that it writes in memory, so there are no more until each holds 8 MB of files."""
    from txnwatch.operators import trailing

    def parts(size, **how):
        monkeypatch.setattr(trailing, "_read_bytes", lambda df: size)
        return trailing.spread(spark.range(4).withColumn("k", F.col("id")), ["k"], **how).rdd.getNumPartitions()

    mb = 1 << 20
    assert parts(120 * mb) == 120
    assert parts(720 * mb) == 200 and parts(1600 * mb) == 200
    assert parts(1608 * mb) == 201
    assert parts(720 * mb, part_bytes=8 * mb) == 90


def test_batches_are_numbered_in_exchanges_that_grow_with_the_input(spark, tmp_path, monkeypatch):
    from txnwatch.operators import trailing
    from txnwatch.plans import feed

    schema = "batch_id BIGINT, alert_id STRING, kafka_partition INT, kafka_offset BIGINT"
    rows = [(i % 40 if i % 13 else None, f"A{i * 7 % 50}" if i % 11 else None, i % 3, i) for i in range(600)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/alerts")
    alerts = spark.read.schema(schema).parquet(f"{tmp_path}/alerts")
    place = feed.Place(3, 7)
    plain, page = feed.after(alerts, place).collect(), feed.after(alerts, place, 20).collect()
    monkeypatch.setattr(trailing, "SPREAD_BYTES", 100)
    wide = feed.after(alerts, place)
    assert "REPARTITION_BY_NUM" in _plan(wide)
    assert wide.collect() == plain and plain[:20] == page
    assert "REPARTITION_BY_NUM" not in _plan(feed.after(alerts, place, 20))  # a poll's cost does not follow the table's size
