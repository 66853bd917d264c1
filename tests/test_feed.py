"""A reader that polls between any two writes of the job, under a clock that goes back, sees each alert once."""

from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_stream_replay import T0, _envelopes

from txnwatch.plans import feed, reports
from txnwatch.streaming import StreamJob, job, read_table

NIGHT = 13 * 3600


def batches(spark, n, alerts):
    return [_envelopes(spark, [(100 * b + k, f"T{b}-{k}", f"U{k}", NIGHT + 60 * b + k, 9000) for k in range(alerts)]) for b in range(n)]


@pytest.mark.parametrize("page", [1, 2, 100])
def test_each_alert_comes_in_one_poll(spark, scratch, monkeypatch, page):
    clock = iter((T0 + timedelta(days=30 - k)).timestamp() for k in range(50))  # every stamp is a day before the last
    monkeypatch.setattr(job.time, "time_ns", lambda: int(next(clock) * 1e9))
    reader, seen, polls = feed.AlertReader(spark, scratch), Counter(), 0

    def poll():
        nonlocal polls
        polls += 1
        seen.update(r.alert_id for r in reader.poll(page))

    inner = StreamJob._write

    def written(self, *args):
        inner(self, *args)
        poll()

    monkeypatch.setattr(StreamJob, "_write", written)
    for b, batch in enumerate(batches(spark, 3, 3)):
        stream = StreamJob(scratch)
        stream.process_batch(batch, b)
        if b == 1:
            StreamJob(scratch).process_batch(batch, b)  # a replay
        poll()
    reader = feed.AlertReader(spark, scratch, reader.place)  # another reader goes on from the place
    for _ in range(16):
        poll()
    alerts = read_table(spark, scratch, "alerts")
    assert seen == Counter(r.alert_id for r in alerts.collect()) and len(seen) == 15 and polls > 12
    # By the clock, the later batches are never after what was read first.
    newest = alerts.agg(F.max("alert_time")).first()[0]
    assert reports.alerts_since(alerts, F.lit(newest)).count() == 0
    assert alerts.where("batch_id > 0").agg(F.max("alert_time")).first()[0] < newest


def test_nothing_of_an_unfinished_batch_is_read(spark, scratch, monkeypatch):
    (first, second) = batches(spark, 2, 2)
    StreamJob(scratch).process_batch(first, 0)
    run_all = job._run_all

    def interrupted(tasks):
        run_all(tasks)
        raise RuntimeError("lost")

    monkeypatch.setattr(job, "_run_all", interrupted)  # alerts are written, the log entry, the last of the writes, is not
    with pytest.raises(RuntimeError, match="lost"):
        StreamJob(scratch).process_batch(second, 1)
    assert read_table(spark, scratch, "alerts").where("batch_id = 1").count() == 2
    reader = feed.AlertReader(spark, scratch)
    assert {r.batch_id for r in reader.poll(100)} == {0} and reader.poll(100) == []
    monkeypatch.undo()
    StreamJob(scratch).process_batch(second, 1)
    assert [r.batch_id for r in reader.poll(100)] == [1, 1] and reader.place == feed.Place(1, 2)


def test_places_of_a_table_without_alerts(spark, scratch):
    reader = feed.AlertReader(spark, scratch)
    assert reader.poll(5) == [] and reader.place == feed.Place()
    none = feed.after(feed.committed(spark, scratch, feed.Place()), feed.Place(4, 2))
    assert tuple(feed.next_place(none, feed.Place(4, 2)).first()) == (4, 2)
