"""Replay, zones and colliding ids on the live job: small inputs with known answers."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from txnwatch.config import RuleSet
from txnwatch.plans import catalog
from txnwatch.schemas import ENVELOPE
from txnwatch.sources.events import load_transactions
from txnwatch.sources.wire import to_envelope
from txnwatch.streaming import StreamJob, late_rows, read_table
from txnwatch.streaming.job import alert_feed

T0 = datetime(2024, 3, 5, 12, tzinfo=timezone.utc)


def _envelopes(spark, rows):
    """rows: (offset, transaction, user, seconds after T0, amount)."""
    data = [(t, u, "M1", float(a), "USD", int((T0 + timedelta(seconds=s)).timestamp() * 1_000_000), 10.0, 20.0, "X",
             "10.1.2.3", "D", "purchase", 0, o) for o, t, u, s, a in rows]
    df = spark.createDataFrame(data, "transaction_id string, user_id string, merchant_id string, amount double, currency string, "
                               "us long, latitude double, longitude double, city string, ip_address string, device_id string, "
                               "transaction_type string, kafka_partition int, kafka_offset long")
    df = df.withColumn("timestamp", F.timestamp_micros("us")).drop("us")
    env = to_envelope(df.withColumn("timestamp", F.to_utc_timestamp("timestamp", "UTC")))
    return spark.createDataFrame(env.collect(), ENVELOPE)


def _counts(spark, root):
    return {t: read_table(spark, root, t).count() for t in ("bronze", "silver")} | {"late": late_rows(spark, root).count()}


@pytest.mark.parametrize("jump, back", [(100_000, -5_000), (2_400, -1_200)])
def test_replay_after_a_jump_changes_nothing(spark, scratch, jump, back):
    first = _envelopes(spark, [(0, "A", "U1", 0, 10)])
    second = _envelopes(spark, [(1, "B", "U1", jump, 10)] + [(k, f"L{k}", "U2", back + k, 10) for k in range(2, 9)])
    job = StreamJob(scratch)
    job.process_batch(first, 0)
    job.process_batch(second, 1)
    before = _counts(spark, scratch)
    assert before == {"bronze": 9, "silver": 9, "late": 7}
    for _ in range(2):
        StreamJob(scratch).process_batch(second, 1)
    assert _counts(spark, scratch) == before
    assert read_table(spark, scratch, "_batches").count() == 2


def test_alert_feed_gives_each_alert_once_across_a_replay(spark, scratch):
    night = 13 * 3600  # 01:00 UTC of the next day
    batch = _envelopes(spark, [(0, "A", "U1", night, 9000)])
    StreamJob(scratch).process_batch(batch, 0)
    StreamJob(scratch).process_batch(batch, 0)
    seen = []

    def take(df, _):
        seen.extend(r.alert_id for r in df.collect())

    for _ in range(2):
        feed = alert_feed(spark, scratch).writeStream.foreachBatch(take).option("checkpointLocation", f"{scratch}/feed")
        feed.trigger(availableNow=True).start().awaitTermination()
        StreamJob(scratch).process_batch(batch, 0)
    assert len(seen) == 1 and read_table(spark, scratch, "alerts").count() == 1


def test_equal_transaction_ids_of_two_users_give_two_alerts(spark, scratch):
    night = 13 * 3600
    job = StreamJob(scratch)
    job.process_batch(_envelopes(spark, [(0, "A", "U1", night, 9000)]), 0)
    job.process_batch(_envelopes(spark, [(1, "A", "U2", night + 30, 9000)]), 1)
    rows = read_table(spark, scratch, "alerts").select("alert_id", "kafka_offset").collect()
    assert sorted(r.kafka_offset for r in rows) == [0, 1] and len({r.alert_id for r in rows}) == 1


def test_session_zone_changes_no_alert_and_no_stamp(spark, scratch):
    burst = _envelopes(spark, [(k, f"B{k}", "U1", 6 * 3600 + 20 * k, 10) for k in range(6)])  # 18:00 UTC
    before = datetime.now(timezone.utc).timestamp()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        StreamJob(scratch, rules=RuleSet()).process_batch(burst, 0)
        assert read_table(spark, scratch, "alerts").count() >= 1
        stamps = read_table(spark, scratch, "bronze").select(F.unix_micros("ingest_time").alias("u"), "event_date").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(before - 5 <= r.u / 1e6 <= before + 300 for r in stamps)
    assert {str(r.event_date) for r in stamps} == {"2024-03-05"}


def test_scoring_a_large_batch_does_not_leave_a_file_for_each_megabyte(spark, scratch, monkeypatch):
    """The rules' exchanges of a batch are sized by EXCHANGE_BYTES; a partition a MB wrote an alert file each, for each rule and date."""
    from txnwatch.operators import trailing

    seen = []
    real = trailing.spread

    def spied(df, keys, source=None, part_bytes=None):
        seen.append(part_bytes)
        return real(df, keys, source, part_bytes)

    monkeypatch.setattr(trailing, "spread", spied)
    monkeypatch.setattr("txnwatch.operators.fused.spread", spied)
    StreamJob(scratch, rules=catalog.WIDE).process_batch(to_envelope(load_transactions(spark, "/root/testdata/sf0.001")), 0)
    assert seen and set(seen) == {8 << 20}
