"""Distinct accounts from sketches: exact for few, within the stated error for many, for every merchant."""

import pytest

from txnwatch.operators.sketches import LG_K, trailing_distinct_sketch


@pytest.mark.parametrize("lg_k", [9, LG_K])
def test_estimates_stay_within_four_standard_errors(spark, lg_k):
    # merchant m has 200 * (m + 1) ** 2 accounts a bucket, of which half are new in each bucket; merchant 7 most of the rows
    rows = spark.range(8).selectExpr("id AS m", "200 * (id + 1) * (id + 1) AS n").selectExpr("m", "n", "explode(sequence(0, 4)) AS b")
    rows = rows.selectExpr("m", "b", "n", "explode(sequence(0L, n - 1)) AS i").selectExpr("concat('M', m) AS merchant", "concat(m, '/', b * (n div 2) + i) AS user", "timestamp_seconds(1200 * b + i % 1200) AS at")
    got = {(r.merchant, r.bucket_end): r.c for r in trailing_distinct_sketch(rows, "merchant", "user", "at", 1200, 3, "c", lg_k).collect()}
    assert len(got) == 40
    for m in range(8):
        n = 200 * (m + 1) ** 2
        for b in range(5):
            exact = n + min(b, 2) * (n // 2)
            assert abs(got[f"M{m}", 1200 * (b + 1)] - exact) <= max(1, 4 * 1.04 / 2 ** (lg_k / 2) * exact)


def test_odd_rows(spark):
    data = [(None, "a", 0), (None, "a", 5), ("M", None, 0), ("M", "x", 700), ("M", "y", None), ("M", "z", 5000), (None, "b", 600)]
    df = spark.createDataFrame(data, "merchant string, user string, sec long").selectExpr("merchant", "user", "timestamp_seconds(sec) AS at", "1 AS k", "2 AS s")
    got = sorted((str(r.merchant), r.bucket_end, r.c) for r in trailing_distinct_sketch(df, "merchant", "user", "at", 600, 2, "c").collect())
    assert got == [("M", 600, 0), ("M", 1200, 1), ("M", 5400, 1), ("None", 600, 1), ("None", 1200, 2)]
    assert trailing_distinct_sketch(df.where("false"), "merchant", "user", "at", 600, 2, "c").collect() == []
