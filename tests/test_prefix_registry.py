"""Prefix-sum counts against brute force, and rules that share their exchanges."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import BASE, frame, txn

from txnwatch.operators import registry
from txnwatch.operators.prefix import counts_by_second, with_counts
from txnwatch.operators.registry import CountRule, RowRule
from txnwatch.operators.rules import check_merchant_velocity, check_velocity
from txnwatch.operators.trailing import trailing_count


def some(spark, seed, n=300, span=4000, users=5):
    rng = random.Random(seed)
    rows = [txn(f"T{i}", BASE + timedelta(seconds=rng.randrange(span), microseconds=rng.randrange(10**6)), user=rng.choice([None, "A", "A", "A", *map(str, range(users))]),
                merchant=rng.choice(["M1", "M2"]), amount=rng.randrange(100)) for i in range(n)]
    return rows, frame(spark, rows)


@pytest.mark.parametrize("seed,window,block", [(1, 0, 7), (2, 59, 60), (3, 60, 60), (4, 61, 60), (5, 500, 33), (6, 3000, 3600), (7, 10_000, 1000)])
def test_counts_equal_brute_force_for_any_block(spark, seed, window, block):
    rows, df = some(spark, seed)
    sec = {r[0]: (r[1], int((r[4] - datetime(1970, 1, 1)).total_seconds() // 1)) for r in rows}
    want = {t: (sum(u == u2 and s - window <= s2 <= s for u2, s2 in sec.values()), sum(u == u2 and s - 2 * window - 1 <= s2 <= s for u2, s2 in sec.values()))
            for t, (u, s) in sec.items()}
    got = with_counts(df, "user_id", "timestamp", {"c": window, "wide one": 2 * window + 1}, block=block).collect()
    assert {r.transaction_id: (r.c, r["wide one"]) for r in got} == want


def test_rules_equal_the_other_strategies_and_odd_rows(spark):
    rows, df = some(spark, 9)
    for check in (check_velocity, check_merchant_velocity):
        got, want = (check(df, 5, 4, strategy=s) for s in ("prefix", "window"))
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count()
    assert with_counts(df.where("false"), "user_id", "timestamp", {"c": 60}).collect() == []
    timeless = frame(spark, [*rows[:3], (*rows[0][:4], None, *rows[0][5:])])
    assert with_counts(timeless, "user_id", "timestamp", {"c": 60}).count() == 3
    other = df.withColumnsRenamed({"user_id": "k", "device_id": "n", "ip_address": "s"})  # names the operator uses inside
    assert sorted(r.c for r in with_counts(other, "k", "timestamp", {"c": 60}).collect()) == sorted(r.c for r in with_counts(df, "user_id", "timestamp", {"c": 60}).collect())


def test_a_hot_key_is_a_row_a_second_and_a_window_partition_a_block(spark):
    n = 20_000
    df = spark.range(n).selectExpr("'hot' AS user_id", "timestamp_seconds(1700000000 + id % 5000) AS timestamp", "id AS transaction_id")
    got = counts_by_second(df, "user_id", "timestamp", {"c": 600}, block=500)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and plan.count("hashpartitioning(k#") >= 1
    rows = {r["__sec"] - 1700000000: r.c for r in got.collect()}
    assert len(rows) == 5000 and rows[0] == 4 and rows[600] == rows[4999] == 4 * 601


def exchanges(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("Exchange hash" in line and "Reused" not in line for line in text.splitlines())


def test_a_fifth_rule_needs_no_change_and_no_exchange(spark):
    rows, df = some(spark, 11)
    four = [CountRule("A", "user_id", 5, 4), CountRule("B", "merchant_id", 1, 3), RowRule("C", "amount > 90"), RowRule("D", "user_id IS NULL")]
    fifth = CountRule("E", "user_id", 30, 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        alone, both = registry.score(df, four), registry.score(df, [*four, fifth])
        assert exchanges(alone) == exchanges(both)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = both.collect()
    for tag, key, minutes, threshold in (("A", "user_id", 5, 4), ("B", "merchant_id", 1, 3), ("E", "user_id", 30, 20)):
        counted = trailing_count(df, key, "timestamp", minutes * 60, "n", strategy="window").where(f"n > {threshold}")
        assert sorted((r.transaction_id, r.n) for r in counted.collect()) == sorted((r.transaction_id, r.evidence) for r in got if r.rule_type == tag)
    assert {r.transaction_id for r in got if r.rule_type == "C"} == {r[0] for r in rows if r[3] > 90}
    assert {r.transaction_id for r in got if r.rule_type == "D"} == {r[0] for r in rows if r[1] is None}


def test_registry_edges(spark):
    _, df = some(spark, 12, n=5)
    none = registry.score(df, [])
    assert none.columns == [*df.columns, "rule_type", "evidence"] and none.count() == 0
    with pytest.raises(ValueError, match="one tag"):
        registry.score(df, [RowRule("X", "true"), CountRule("X", "user_id", 1, 1)])
    assert {r.rule_type for r in registry.score(df, [RowRule("it's", "true")]).collect()} == {"it's"}


def test_block_totals_are_met_without_a_join(spark):
    """A day's window of hours: no side that a wrong estimate broadcasts, no block copied to the 25 after it."""
    df = spark.range(4000).selectExpr("concat('U', id % 7) AS user_id", "timestamp_seconds(1700000000 + 97 * id) AS timestamp", "id AS transaction_id")
    got = counts_by_second(df, "user_id", "timestamp", {"day": 86_400, "hour": 3600})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan and "sequence(1" not in plan
    day = {(r.user_id, r["__sec"]): r.txn_count for r in trailing_count(df, "user_id", "timestamp", 86_400, "txn_count").selectExpr("user_id", "unix_seconds(timestamp) AS __sec", "txn_count").collect()}
    assert {(r.user_id, r["__sec"]): r.day for r in got.collect()} == day and len(day) == 4000
