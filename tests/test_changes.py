"""The R2 change log: folded, it equals the rule over all rows after any order of arrival, and after a replay."""

import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest

from txnwatch.config import RuleSet
from txnwatch.operators.rules import check_geo_jump
from txnwatch.streaming import measured
from txnwatch.streaming.changes import GeoChangeLog

RULES = RuleSet().replace(r2=dict(max_interval_minutes=10, max_distance_km=100))
PLACES = ((40.7128, -74.0060), (35.6762, 139.6503), (51.5074, -0.1278))
SCHEMA = ("transaction_id string, user_id string, timestamp timestamp, latitude double, longitude double, "
          "kafka_partition int, kafka_offset long")


def _rows(seed, n):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        lat, lon = draw.choice(PLACES)
        when = datetime(2024, 1, 15, 23, 30) + timedelta(seconds=draw.randrange(5400))
        # ids collide, and one user has most rows
        out.append((f"T{i % 7}", draw.choice(["U1", "U1", "U2"]), when, lat, lon, 0, i))
    return out


def _wanted(df):
    hits = check_geo_jump(df, RULES.r2.max_distance_km, RULES.r2.max_interval_minutes)
    return sorted((r.kafka_offset, int(r.prev_ts.timestamp()), round(r.distance_km, 6)) for r in hits.collect())


def _held(changes, spark):
    return sorted((r.kafka_offset, r.prev_sec, round(r.distance_km, 6)) for r in changes.current(spark).collect())


@pytest.mark.parametrize("seed, cuts", [(1, [20, 40]), (2, [5, 10, 50])])
def test_folded_log_equals_the_rule_after_every_batch(spark, scratch, seed, cuts):
    data = _rows(seed, 60)
    changes = GeoChangeLog(scratch, RULES)
    bounds = [0, *cuts, len(data)]
    for b, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        history, batch = spark.createDataFrame(data[:hi], SCHEMA), spark.createDataFrame(data[lo:hi], SCHEMA)
        changes.advance(history, batch, b)
        assert _held(changes, spark) == _wanted(history)
    log = changes.log(spark)
    assert log.where("op = 'retract'").count() > 0
    before = sorted(map(tuple, log.collect()), key=repr)
    GeoChangeLog(scratch, RULES).advance(history, batch, b)  # a replay of the last batch by a new process
    assert sorted(map(tuple, changes.log(spark).collect()), key=repr) == before


def test_late_row_between_two_withdraws_the_alert(spark, scratch):
    t0 = datetime(2024, 1, 15, 12)
    a, b = (("A", "U1", t0, *PLACES[0], 0, 0), ("B", "U1", t0 + timedelta(seconds=300), *PLACES[1], 0, 1))
    late = ("C", "U1", t0 + timedelta(seconds=200), *PLACES[1], 0, 2)
    changes = GeoChangeLog(scratch, RULES)
    changes.advance(spark.createDataFrame([a, b], SCHEMA), spark.createDataFrame([a, b], SCHEMA), 0)
    assert [r.alert_id for r in changes.current(spark).collect()] == ["ALERT-GEO_JUMP-B"]
    changes.advance(spark.createDataFrame([a, b, late], SCHEMA), spark.createDataFrame([late], SCHEMA), 1)
    assert [r.alert_id for r in changes.current(spark).collect()] == ["ALERT-GEO_JUMP-C"]
    assert sorted((r.batch_id, r.op, r.transaction_id) for r in changes.log(spark).collect()) == [
        (0, "insert", "B"), (1, "insert", "C"), (1, "retract", "B")]


def test_odd_batches_change_nothing(spark, scratch):
    changes = GeoChangeLog(scratch, RULES)
    assert changes.current(spark).count() == 0
    odd = spark.createDataFrame([("A", None, datetime(2024, 1, 1), 1.0, 2.0, 0, 0), ("B", "U1", None, 1.0, 2.0, 0, 1)], SCHEMA)
    changes.advance(odd, odd, 0)
    changes.advance(odd, odd.where("false"), 1)
    assert changes.log(spark).count() == 0


def test_throughput_from_progress(spark):
    seen = [{"batchId": 0, "numInputRows": 100, "durationMs": {"triggerExecution": 500}},
            {"batchId": 1, "numInputRows": 0, "durationMs": {}},
            {"batchId": 2, "numInputRows": 300, "durationMs": {"triggerExecution": 500}}]
    got = measured.throughput(measured.progress(spark, SimpleNamespace(recentProgress=seen))).first()
    assert (got.batches, got.rows, got.rows_per_sec, got.peak_rows_per_sec) == (2, 400, 400.0, 600.0)
    none = measured.throughput(measured.progress(spark, SimpleNamespace(recentProgress=[]))).first()
    assert (none.batches, none.rows_per_sec) == (0, None)
