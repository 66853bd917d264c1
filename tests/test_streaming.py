"""Streaming job: stream = batch, replay safety, late data, window counts."""

import glob
import os
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from txnwatch.config import RuleSet
from txnwatch.operators.alerts import to_alerts
from txnwatch.operators.rules import apply_all_rules
from txnwatch.plans.catalog import WIDE
from txnwatch.schemas import ENVELOPE
from txnwatch.sources.events import load_transactions
from txnwatch.sources.streams import envelope_file_stream
from txnwatch.sources.wire import parse_wire, to_envelope
from txnwatch.streaming import StreamJob, late_rows, read_table
from txnwatch.streaming.counts import streaming_window_counts
from txnwatch.operators.windows import window_counts

from helpers import SF001


def _split_files(spark, scratch, k):
    """The events-derived envelopes as k JSON files in event order."""
    env = to_envelope(load_transactions(spark, SF001))
    n = env.count()
    env = env.withColumn("part", (F.col("offset") * k / n).cast("int"))
    env.repartition(1).write.partitionBy("part").json(f"{scratch}/parts")
    os.makedirs(f"{scratch}/in")
    dirs = sorted(glob.glob(f"{scratch}/parts/part=*"), key=lambda p: int(p.split("=")[1]))
    for i, d in enumerate(dirs):
        for f in glob.glob(f"{d}/*.json"):
            target = f"{scratch}/in/{i:04d}.json"
            shutil.copy(f, target)
            # the file source takes files oldest first: make the order explicit
            os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    return f"{scratch}/in"


@pytest.mark.parametrize("k", [1, 3, 10])
def test_stream_equals_batch(spark, scratch, k):
    src = envelope_file_stream(spark, _split_files(spark, scratch, k), max_files_per_trigger=1)
    job = StreamJob(f"{scratch}/out", rules=WIDE)
    job.run_available(src)
    got = read_table(spark, job.root, "alerts").select("alert_id", "trigger_detail")
    want = to_alerts(apply_all_rules(load_transactions(spark, SF001), WIDE), WIDE) \
        .select("alert_id", "trigger_detail")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert read_table(spark, job.root, "_batches").count() == k
    assert read_table(spark, job.root, "bronze").count() == 1000
    assert read_table(spark, job.root, "silver").count() == 1000


def _env(spark, rows):
    """rows: (offset, user, seconds after T0, amount)."""
    t0 = datetime(2024, 1, 15, 12)
    recs = []
    for off, user, sec, amount in rows:
        ts = (t0 + timedelta(seconds=sec)).strftime("%Y-%m-%dT%H:%M:%SZ")
        value = ('{"transaction_id":"T%d","user_id":"%s","merchant_id":"M%d","amount":%s,'
                 '"currency":"USD","timestamp":"%s","location":{"latitude":40.7,'
                 '"longitude":-74.0,"city":"NY"},"ip_address":"10.1.2.3","device_id":"D",'
                 '"transaction_type":"purchase"}') % (off, user, off, amount, ts)
        recs.append((value, 0, off))
    return spark.createDataFrame(recs, ENVELOPE)


def test_replay_of_a_batch_is_idempotent(spark, scratch):
    job = StreamJob(scratch, rules=RuleSet())
    batch = _env(spark, [(i, "U1", 60 * i, 100.0) for i in range(6)] + [(99, "U2", 0, "oops")])
    job.process_batch(batch, 0)
    first = {t: read_table(spark, scratch, t).collect() for t in ("bronze", "silver", "alerts")}
    job2 = StreamJob(scratch, rules=RuleSet())       # a restarted driver replays batch 0
    job2.process_batch(batch, 0)
    for t, rows in first.items():
        assert sorted(map(tuple, read_table(spark, scratch, t).collect())) == sorted(map(tuple, rows))
    assert [r.transaction_id for r in first["alerts"]] == ["T5"]
    assert read_table(spark, scratch, "rejects").count() == 1


def test_late_rows_kept_but_not_scored(spark, scratch):
    job = StreamJob(scratch, rules=RuleSet())
    job.process_batch(_env(spark, [(1, "U1", 3600, 10.0)]), 0)
    # 20 minutes behind the max seen so far: beyond the 10-minute watermark
    late = [(10 + i, "U9", 3600 - 1200 + i, 10.0) for i in range(7)]
    job.process_batch(_env(spark, late), 1)
    assert sorted(r.transaction_id for r in late_rows(spark, scratch).collect()) == \
        [f"T{10 + i}" for i in range(7)]
    assert read_table(spark, scratch, "alerts").filter("rule_type = 'VELOCITY_FRAUD'").count() == 0


def test_out_of_order_arrival_rescores_earlier_rows(spark, scratch):
    job = StreamJob(scratch, rules=RuleSet())
    job.process_batch(_env(spark, [(i, "U1", 60 + 60 * i, 10.0) for i in range(5)]), 0)
    assert read_table(spark, scratch, "alerts").count() == 0
    # one minute before the first row, inside the watermark: the row at 5 min
    # now sees 6 transactions in its 5-minute frame
    job.process_batch(_env(spark, [(50, "U1", 0, 10.0)]), 1)
    alerts = read_table(spark, scratch, "alerts").collect()
    assert [(a.transaction_id, a.batch_id) for a in alerts] == [("T4", 1)]
    # replaying batch 1 leaves exactly one copy
    job.process_batch(_env(spark, [(50, "U1", 0, 10.0)]), 1)
    assert read_table(spark, scratch, "alerts").count() == 1


def test_streaming_window_counts_match_batch(spark, scratch):
    src_dir = _split_files(spark, scratch, 2)
    stream = parse_wire(envelope_file_stream(spark, src_dir, max_files_per_trigger=1))
    counts = streaming_window_counts(stream, "user_id", "1 day", None, watermark="1 hour")
    q = (counts.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True)
         .start(f"{scratch}/counts"))
    q.awaitTermination()
    got = spark.read.parquet(f"{scratch}/counts")
    want = window_counts(load_transactions(spark, SF001), "user_id", "1 day") \
        .withColumn("window_start", F.col("window_start").cast("timestamp")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp"))
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0


def test_alert_feed_streams_inserted_alerts(spark, scratch):
    from txnwatch.streaming import alert_feed

    job = StreamJob(f"{scratch}/out", rules=RuleSet())
    job.process_batch(_env(spark, [(i, "U1", 60 * i, 100.0) for i in range(6)]), 0)
    job.process_batch(_env(spark, [(20 + i, "U2", 60 * i, 100.0) for i in range(6)]), 1)
    q = (alert_feed(spark, job.root).writeStream.format("memory").queryName("feed_test")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.alert_id, r.batch_id) for r in spark.sql("SELECT * FROM feed_test").collect())
    assert got == [("ALERT-VELOCITY_FRAUD-T25", 1), ("ALERT-VELOCITY_FRAUD-T5", 0)]


def test_batch_log_stays_bounded_and_restarts_from_recent_entries(spark, scratch):
    job = StreamJob(scratch, rules=RuleSet())
    for b in range(6):   # one transaction per batch, an hour apart
        job.process_batch(_env(spark, [(b, "U1", 3600 * b, 10.0)]), b)
    assert len(job._seen) <= 2 and 5 in job._seen
    assert read_table(spark, scratch, "_batches").count() == 6
    restarted = StreamJob(scratch, rules=RuleSet())
    seen = restarted._load_log(spark)
    assert 5 in seen and len(seen) <= 2
    # the restarted job keeps the watermark: a row two hours back is late
    restarted.process_batch(_env(spark, [(99, "U2", 3600 * 5 - 7200, 10.0)]), 6)
    assert [r.transaction_id for r in late_rows(spark, scratch).collect()] == ["T99"]


def test_empty_micro_batch_is_logged_and_harmless(spark, scratch):
    job = StreamJob(scratch, rules=RuleSet())
    job.process_batch(spark.createDataFrame([], ENVELOPE), 0)
    job.process_batch(_env(spark, [(i, "U1", 60 * i, 100.0) for i in range(6)]), 1)
    assert sorted(r.batch_id for r in read_table(spark, scratch, "_batches").collect()) == [0, 1]
    assert [r.transaction_id for r in read_table(spark, scratch, "alerts").collect()] == ["T5"]
