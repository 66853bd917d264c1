"""Bucketed trailing operators equal a brute-force definition on random input
(hot keys, same-second peers, exact-boundary gaps)."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from txnwatch.config import RuleSet
from txnwatch.operators.trailing import previous_within, trailing_count, trailing_distinct

SCHEMA = StructType([
    StructField("id", LongType()), StructField("k", StringType()),
    StructField("u", StringType()), StructField("ts", TimestampType()),
])
T0 = datetime(2024, 1, 1)

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]),
              st.sampled_from(["u1", "u2", "u3"]),
              st.integers(0, 400), st.sampled_from([0, 250_000, 999_999])),
    min_size=1, max_size=60)


def _frame(spark, rows):
    data = [(i, k, u, T0 + timedelta(seconds=s, microseconds=us))
            for i, (k, u, s, us) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA), data


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, w=st.sampled_from([1, 7, 30, 90]))
def test_trailing_count_and_distinct(spark, rows, w):
    df, data = _frame(spark, rows)
    sec = {i: int((ts - datetime(1970, 1, 1)).total_seconds() // 1) for i, _, _, ts in data}
    want_c, want_d = {}, {}
    for i, k, _, _ in data:
        frame_rows = [(j, u) for j, k2, u, _ in data if k2 == k and sec[i] - w <= sec[j] <= sec[i]]
        want_c[i] = len(frame_rows)
        want_d[i] = len({u for _, u in frame_rows})
    got_c = {r.id: r.n for r in trailing_count(df, "k", "ts", w, "n").collect()}
    got_d = {r.id: r.n for r in trailing_distinct(df, "k", "u", "ts", w, "n").collect()}
    assert got_c == want_c
    assert got_d == want_d


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, gap=st.sampled_from([1, 10, 60]))
def test_previous_within(spark, rows, gap):
    df, data = _frame(spark, rows)
    ordered = sorted(data, key=lambda r: (r[1], r[3], r[0]))
    want = {}
    for pos, (i, k, _, ts) in enumerate(ordered):
        prev = ordered[pos - 1] if pos and ordered[pos - 1][1] == k else None
        want[i] = prev[0] if prev else None
    got = {r.id: r.prev_id for r in
           previous_within(df, "k", "ts", ["id"], ["id", "ts"], gap).collect()}
    sec = lambda t: int((t - datetime(1970, 1, 1)).total_seconds() // 1)
    by_id = {i: ts for i, _, _, ts in data}
    for i, p in want.items():
        if p is not None and sec(by_id[i]) - sec(by_id[p]) < gap:
            assert got[i] == p
        else:
            assert got[i] in (None, p)


FUSED_SCHEMA = StructType([
    StructField("transaction_id", StringType()), StructField("user_id", StringType()),
    StructField("merchant_id", StringType()), StructField("amount", DoubleType()),
    StructField("timestamp", TimestampType()),
    StructField("latitude", DoubleType()), StructField("longitude", DoubleType()),
])
PLACES = [(40.7128, -74.0060), (35.6762, 139.6503), (51.5074, -0.1278), (None, None)]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a"]),
                               st.integers(0, 900), st.sampled_from([0, 500_000]),
                               st.integers(0, 3)), min_size=1, max_size=50),
       w_min=st.sampled_from([0.5, 2, 5]), gap_min=st.sampled_from([1, 2, 5, 8]),
       thr=st.sampled_from([1, 2]))
def test_fused_user_rules_equal_plain_window(spark, rows, w_min, gap_min, thr):
    from txnwatch.operators.rules import apply_all_rules

    data = [(f"T{i:03d}", u, "M1", 1.0, T0 + timedelta(seconds=s, microseconds=us), *PLACES[p])
            for i, (u, s, us, p) in enumerate(rows)]
    df = spark.createDataFrame(data, FUSED_SCHEMA)
    rules = RuleSet().replace(r1=dict(window_minutes=w_min, threshold=thr),
                              r2=dict(max_interval_minutes=gap_min, max_distance_km=100),
                              r3=dict(enabled=False), r4=dict(enabled=False))
    fused = apply_all_rules(df, rules)
    plain = apply_all_rules(df, rules, strategy="window")
    assert "__copy" in fused._jdf.queryExecution().executedPlan().toString()
    assert fused.exceptAll(plain).count() == 0 and plain.exceptAll(fused).count() == 0
