"""Rule semantics against brute force, and their boundaries, for every strategy."""

import random
from datetime import datetime

import pytest
from helpers import BASE, NEW_YORK, TOKYO, frame, ids, minutes, seconds, txn

from txnwatch.config import RuleSet
from txnwatch.operators import rules as R

STRATS = ["bucketed", "window"]


# ---- R3 -------------------------------------------------------------------

def test_night_large_is_its_condition_on_any_row(spark):
    """All hours of two days against amounts around the limit, by plain arithmetic."""
    amounts = (0.0, 4999.99, 5000.0, 5000.01, 80_000.0, float("nan"))
    rows = [txn(f"{h}/{a}", datetime(2023, 12, 31) + minutes(60 * h + 7 * h % 60), amount=a) for h in range(48) for a in amounts]
    for least, start, end in ((5000, 0, 5), (100, 22, 24), (5000, 3, 3)):
        want = sorted(r[0] for r in rows if not r[3] <= least and start <= r[4].hour < end)  # NaN is above every number
        assert ids(R.check_night_large(frame(spark, rows), least, start, end)) == want


def test_night_large_boundaries(spark):
    rows = [
        txn("A", datetime(2024, 1, 15, 3), amount=5000.0),
        txn("B", datetime(2024, 1, 15, 3), amount=5000.01),
        txn("C", datetime(2024, 1, 15, 0), amount=6000.0),
        txn("D", datetime(2024, 1, 15, 5), amount=6000.0),
    ]
    assert ids(R.check_night_large(frame(spark, rows), 5000, 0, 5)) == ["B", "C"]


# ---- R1 -------------------------------------------------------------------

@pytest.mark.parametrize("strategy", [*STRATS, "prefix"])
@pytest.mark.parametrize("window,threshold", [(2, 1), (7, 3), (45, 9)])
def test_velocity_counts_what_a_double_loop_counts(spark, strategy, window, threshold):
    rng = random.Random(window)
    rows = [txn(f"V{i}", BASE + seconds(rng.randrange(4 * 3600)), user=rng.choice("AAAB")) for i in range(150)]
    count = {r[0]: sum(o[1] == r[1] and r[4] - minutes(window) <= o[4] <= r[4] for o in rows) for r in rows}
    got = R.check_velocity(frame(spark, rows), window, threshold, strategy).collect()
    want = {t: n for t, n in count.items() if n > threshold}
    assert {r.transaction_id: r.txn_count for r in got} == want and 0 < len(want) < len(rows)


@pytest.mark.parametrize("strategy", STRATS)
def test_velocity_frame_is_closed_at_w_and_open_beyond(spark, strategy):
    rows = [txn("A", BASE), txn("B", BASE + seconds(300)), txn("C", BASE + seconds(601))]
    out = {r.transaction_id: r.txn_count
           for r in R.check_velocity(frame(spark, rows), 5, 0, strategy).collect()}
    assert out == {"A": 1, "B": 2, "C": 1}


@pytest.mark.parametrize("strategy", STRATS)
def test_velocity_counts_same_second_peers(spark, strategy):
    rows = [txn("A", BASE), txn("B", BASE + seconds(0.2)), txn("C", BASE + seconds(0.9))]
    out = R.check_velocity(frame(spark, rows), 5, 2, strategy)
    assert ids(out) == ["A", "B", "C"]


@pytest.mark.parametrize("strategy", STRATS)
def test_velocity_exactly_at_threshold_does_not_fire(spark, strategy):
    rows = [txn(f"V{i}", BASE + minutes(i)) for i in range(5)]
    assert R.check_velocity(frame(spark, rows), 5, 5, strategy).count() == 0


@pytest.mark.parametrize("strategy", STRATS)
def test_velocity_keys_are_separate(spark, strategy):
    rows = [txn(f"A{i}", BASE + seconds(i), user="U1") for i in range(3)]
    rows += [txn(f"B{i}", BASE + seconds(i), user="U2") for i in range(2)]
    out = R.check_velocity(frame(spark, rows), 1, 2, strategy)
    assert ids(out) == ["A2"]


# ---- R4 -------------------------------------------------------------------

@pytest.mark.parametrize("strategy", STRATS)
def test_merchant_velocity_hit(spark, strategy):
    rows = [txn(f"M{i}", BASE + seconds(10 * i), user=f"U{i}") for i in range(4)]
    out = R.check_merchant_velocity(frame(spark, rows), 1, 3, strategy)
    assert [(r.transaction_id, r.merchant_txn_count) for r in out.collect()] == [("M3", 4)]


@pytest.mark.parametrize("strategy", STRATS)
def test_merchant_velocity_miss(spark, strategy):
    rows = [txn("M0", BASE), txn("M1", BASE + seconds(30))]
    assert R.check_merchant_velocity(frame(spark, rows), 1, 3, strategy).count() == 0


@pytest.mark.parametrize("strategy", STRATS)
def test_merchant_distinct_users_counts_accounts_not_rows(spark, strategy):
    rows = [txn(f"X{i}", BASE + seconds(5 * i), user="U1") for i in range(5)]
    rows += [txn("Y0", BASE + seconds(26), user="U2"), txn("Y1", BASE + seconds(27), user="U3")]
    out = R.check_merchant_distinct_users(frame(spark, rows), 1, 2, strategy)
    assert [(r.transaction_id, r.merchant_user_count) for r in out.collect()] == [("Y1", 3)]


# ---- R2 -------------------------------------------------------------------

@pytest.mark.parametrize("strategy", STRATS)
def test_geo_jump_hit(spark, strategy):
    rows = [txn("G0", BASE, where=NEW_YORK), txn("G1", BASE + minutes(5), where=TOKYO)]
    out = R.check_geo_jump(frame(spark, rows), 1000, 10, strategy).collect()
    assert [r.transaction_id for r in out] == ["G1"]
    assert 10800 < out[0].distance_km < 10900
    assert out[0].time_diff_minutes == 5.0


@pytest.mark.parametrize("strategy", STRATS)
def test_geo_jump_miss_same_place(spark, strategy):
    rows = [txn("G0", BASE), txn("G1", BASE + minutes(5))]
    assert R.check_geo_jump(frame(spark, rows), 1000, 10, strategy).count() == 0


@pytest.mark.parametrize("strategy", STRATS)
def test_geo_jump_single_row(spark, strategy):
    assert R.check_geo_jump(frame(spark, [txn("G0", BASE)]), 1000, 10, strategy).count() == 0


@pytest.mark.parametrize("strategy", STRATS)
def test_geo_jump_gap_exactly_limit_does_not_fire(spark, strategy):
    rows = [txn("G0", BASE, where=NEW_YORK), txn("G1", BASE + minutes(10), where=TOKYO),
            txn("G2", BASE + minutes(19) + seconds(59), where=NEW_YORK)]
    assert ids(R.check_geo_jump(frame(spark, rows), 1000, 10, strategy)) == ["G2"]


@pytest.mark.parametrize("strategy", STRATS)
def test_geo_jump_identical_points_never_nan(spark, strategy):
    # law-of-cosines acos rounds above 1 for such points; haversine gives 0
    p = (37.123456789, -122.98765431)
    rows = [txn("G0", BASE, where=p), txn("G1", BASE + seconds(1), where=p)]
    out = R.check_geo_jump(frame(spark, rows), -1, 10, strategy).collect()
    assert [r.distance_km for r in out] == [0.0]


@pytest.mark.parametrize("strategy", STRATS)
def test_geo_jump_previous_without_position_never_fires(spark, strategy):
    rows = [txn("G0", BASE, where=None), txn("G1", BASE + minutes(1), where=TOKYO)]
    assert R.check_geo_jump(frame(spark, rows), 1000, 10, strategy).count() == 0


@pytest.mark.parametrize("strategy", STRATS)
def test_geo_jump_ties_ordered_by_transaction_id(spark, strategy):
    rows = [txn("G1", BASE, where=TOKYO), txn("G0", BASE, where=NEW_YORK)]
    out = R.check_geo_jump(frame(spark, rows), 1000, 10, strategy).collect()
    assert [(r.transaction_id, r.prev_lat) for r in out] == [("G1", NEW_YORK[0])]


# ---- RUL-5 ----------------------------------------------------------------

def _night_series(spark):
    base = datetime(2024, 1, 15, 3)
    return frame(spark, [txn(f"T{i}", base + minutes(i), amount=6000 + i) for i in range(6)])


def test_all_rules_integration(spark):
    out = R.apply_all_rules(_night_series(spark))
    kinds = sorted(r.rule_type for r in out.collect())
    assert kinds == ["NIGHT_LARGE"] * 6 + ["VELOCITY_FRAUD"]


def test_all_rules_single_alert_shape(spark):
    df = frame(spark, [txn("T1", datetime(2024, 1, 15, 3), amount=7000)])
    rows = R.apply_all_rules(df).collect()
    assert len(rows) == 1
    assert rows[0].rule_type == "NIGHT_LARGE" and rows[0].amount == 7000.0
    assert len(rows[0].user_hash) == 64


def test_all_rules_off_gives_typed_empty_frame(spark):
    off = dict(enabled=False)
    rules = RuleSet().replace(r1=off, r2=off, r3=off, r4=off)
    out = R.apply_all_rules(_night_series(spark), rules)
    assert out.count() == 0
    assert "rule_type" in out.columns and "txn_count" in out.columns


def test_all_rules_columns_do_not_depend_on_enabled_rules(spark):
    off = dict(enabled=False)
    full = R.apply_all_rules(_night_series(spark))
    only_r3 = R.apply_all_rules(_night_series(spark), RuleSet().replace(r1=off, r2=off, r4=off))
    shape = lambda d: [(f.name, f.dataType) for f in d.schema.fields]
    assert shape(full) == shape(only_r3)


def test_rules_accept_zone_less_timestamps(spark):
    df = _night_series(spark).withColumn("timestamp", __import__("pyspark.sql.functions",
                                                                 fromlist=["col"]).col("timestamp")
                                         .cast("timestamp_ntz"))
    kinds = sorted(r.rule_type for r in R.apply_all_rules(df).collect())
    assert kinds == ["NIGHT_LARGE"] * 6 + ["VELOCITY_FRAUD"]


def test_bad_strategy_rejected(spark):
    with pytest.raises(ValueError):
        R.check_velocity(_night_series(spark), strategy="nope")


def test_geo_pairs_is_as_of_previous_row(spark):
    from txnwatch.operators.interval_join import geo_pairs

    rows = [txn("A", BASE, where=NEW_YORK), txn("B", BASE + minutes(2), where=NEW_YORK),
            txn("C", BASE + minutes(4), where=TOKYO), txn("D", BASE + minutes(30), where=NEW_YORK)]
    out = [(r.transaction_id, r.prev_transaction_id, r.gap_seconds)
           for r in geo_pairs(frame(spark, rows), 600, 1000).collect()]
    # C pairs with its predecessor B only (not with A); D is beyond the band
    assert out == [("C", "B", 120)]
