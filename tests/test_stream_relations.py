"""Stream-stream pairs and keyed state against the batch result, for several cuts into micro-batches and after a restart."""

import os
import random
from datetime import datetime, timedelta

import pytest

from txnwatch.config import RuleSet
from txnwatch.operators.rules import apply_all_rules
from txnwatch.sources.events import EVENTS_SCHEMA, transactions_from_events
from txnwatch.streaming.keyed import PROVIDER, bucket_width, keyed_user_rules
from txnwatch.streaming.pairs import band_pairs
from txnwatch.streaming.replay import run_to_end, stream_folder, transaction_stream

RULES = RuleSet().replace(r1=dict(window_minutes=10, threshold=3), r2=dict(max_interval_minutes=8))
START = datetime(2024, 3, 1)


def rows(n=400, hours=6, users=4, seed=3):
    """Events in order of arrival: up to nine minutes out of order; user 0 has half of them."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = START + timedelta(seconds=rng.randrange(hours * 3600), microseconds=rng.randrange(1_000_000))
        out.append((i, at, rng.choice([0] * users + list(range(1, users + 1))), "click", 1.0, '{"k": 1}'))
    return sorted(out, key=lambda r: r[1] + timedelta(seconds=rng.uniform(-270, 270)))


def write(spark, folder, events, files, first=0):
    """``files`` files of consecutive arrivals, oldest first by modification time."""
    os.makedirs(folder, exist_ok=True)
    size = -(-len(events) // files)
    for k in range(files):
        part = events[k * size : (k + 1) * size]
        tmp = f"{folder}-{first + k}"
        spark.createDataFrame(part, EVENTS_SCHEMA).coalesce(1).write.parquet(tmp)
        (name,) = [f for f in os.listdir(tmp) if f.endswith(".parquet")]
        target = f"{folder}/{first + k:04d}.parquet"
        os.link(f"{tmp}/{name}", target)
        os.utime(target, (1_700_000_000 + first + k,) * 2)


def batch(spark, events):
    txns = transactions_from_events(spark.createDataFrame(events, EVENTS_SCHEMA))
    return txns.withColumn("timestamp", txns["timestamp"].cast("timestamp"))


def pairs_of(df):
    return sorted((r.user_id, r.transaction_id, r.prev_transaction_id, r.gap_seconds, r.distance_km) for r in df.collect())


@pytest.mark.parametrize("files", [1, 3, 10])
def test_pairs_equal_the_batch_relation(spark, scratch, files):
    events = rows()
    write(spark, f"{scratch}/in", events, files)
    sides = [transaction_stream(spark, f"{scratch}/in", max_files_per_trigger=1) for _ in range(2)]
    got = run_to_end(band_pairs(*sides, 600, 500), stream_folder(spark, "t-pairs"))
    want = []
    txns = {r.transaction_id: r for r in batch(spark, events).collect()}
    sec = {t: int(r.timestamp.timestamp() // 1) for t, r in txns.items()}
    for t, a in txns.items():
        want += [(a.user_id, t, p, sec[t] - sec[p]) for p, b in txns.items() if p != t and a.user_id == b.user_id and a.city != b.city
                 and 0 <= sec[t] - sec[p] <= 600 and (sec[t] > sec[p] or a.kafka_offset > b.kafka_offset)]
    assert [x[:4] for x in pairs_of(got)] == sorted(want) and len(want) > 100


def test_pairs_keep_state_for_the_band_only(spark, scratch):
    write(spark, f"{scratch}/in", rows(600, hours=60), 12)
    sides = [transaction_stream(spark, f"{scratch}/in", max_files_per_trigger=1) for _ in range(2)]
    folder = f"{scratch}/out"
    query = band_pairs(*sides, 600, 500).writeStream.format("parquet").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start(f"{folder}/s")
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(held) >= 12 and max(held) < 3 * 600 / 3  # of three rows for each event; all of them without a watermark


def hits_of(df):
    return sorted((r.user_id, r.transaction_id, r.rule_type, r.txn_count, r.time_diff_minutes) for r in df.collect())


def expected_hits(spark, events):
    """Batch hits of R1 and R2 in the buckets that end by the final watermark."""
    txns = batch(spark, events)
    hits = apply_all_rules(txns, RULES.replace(r3=dict(enabled=False), r4=dict(enabled=False)))
    _, width = bucket_width(RULES)
    newest = max(e[1] for e in events)
    hits = hits.where(f"(floor(unix_seconds(timestamp) / {width}) + 1) * {width} <= {(newest - datetime(1970, 1, 1)).total_seconds() - 600!r}D")
    return hits_of(hits)


def keyed(spark, path, folder):
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return run_to_end(keyed_user_rules(transaction_stream(session, path, max_files_per_trigger=1), RULES), folder, reader=spark)


@pytest.mark.parametrize("files", [1, 3, 10])
def test_keyed_rules_equal_batch_for_every_cut(spark, scratch, files):
    events = rows()
    write(spark, f"{scratch}/in", events, files)
    got = hits_of(keyed(spark, f"{scratch}/in", stream_folder(spark, "t-keyed")))
    want = expected_hits(spark, events)
    assert got == want and {h[2] for h in want} == {"VELOCITY_FRAUD", "GEO_JUMP"}


def test_keyed_rules_go_on_after_a_restart(spark, scratch):
    events = rows(seed=8)
    folder = stream_folder(spark, "t-restart")
    write(spark, f"{scratch}/in", events[:250], 3)
    first = hits_of(keyed(spark, f"{scratch}/in", folder))
    write(spark, f"{scratch}/in", events[250:], 2, first=3)
    both = hits_of(keyed(spark, f"{scratch}/in", folder))
    assert both == expected_hits(spark, events) and 0 < len(first) < len(both)


def test_users_of_a_lane_share_a_group_and_not_their_rows(spark, scratch):
    """A group for each lane and bucket, however many users there are; its users' rows are scored apart."""
    import pandas as pd

    from txnwatch.streaming.keyed import BucketRules, _packed, _unpacked

    at = [("A", 0, 10.0), ("B", 1, 80.0), ("A", 2, 10.0), ("B", 3, 80.0), ("A", 3700, -60.0)]
    rows = pd.DataFrame([(u, False, s, s * 10**6, f"T{i}", None if i else 2**31 - 1, 2**62 + i, lat, 0.0) for i, (u, s, lat) in enumerate(at)],
                        columns=["user_id", "marker", "sec", "micros", "transaction_id", "kafka_partition", "kafka_offset", "latitude", "longitude"])
    held = _unpacked([(_packed(rows[:2]),), (_packed(rows[2:]),)])
    assert held.kafka_offset.to_list() == [2**62 + i for i in range(5)] and held.kafka_partition.to_list() == [2**31 - 1] + [None] * 4
    got = BucketRules(RULES.replace(r1=dict(window_minutes=60, threshold=1), r2=dict(max_distance_km=1000, max_interval_minutes=62)), 7200).hits(held)
    assert [(r.transaction_id, r.rule_type[:3]) for r in got.itertuples()] == [("T2", "VEL"), ("T3", "VEL"), ("T4", "GEO")]
    assert len(BucketRules(RULES, 7200).hits(_unpacked([]))) == 0
    write_users = spark.range(300).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id AS user_id", "'view' AS event_type", "1.0D AS value", "'{\"k\": 1}' AS props")
    write_users.coalesce(1).write.parquet(f"{scratch}/users")
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    plan = keyed_user_rules(transaction_stream(session, f"{scratch}/users"), RULES)._jdf.queryExecution().analyzed().toString()
    assert "TransformWithState" in plan and "lane#" in plan
