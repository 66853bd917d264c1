"""Sketches of counts in buckets: mergeable, bounded, and within 1/64 of the exact quantile."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txnwatch.operators import quantiles as Q

SHARES = {"p10": 0.1, "p50": 0.5, "p95": 0.95, "p100": 1.0}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-10**6, 10**15))), min_size=1, max_size=80))
def test_merged_sketches_are_within_the_error(spark, values):
    rows = spark.createDataFrame(values, "part int, v bigint")
    got = Q.quantiles(Q.merged(Q.histogram(rows, ["part"], "v"), []), [], SHARES).first()
    exact = sorted(v for _, v in values if v is not None)
    assert (got.n or 0) == len(exact)
    for name, share in SHARES.items():
        if exact:
            want = exact[math.ceil(share * len(exact)) - 1]
            assert abs(got[name]) <= abs(want) and abs(want - got[name]) * 64 <= abs(want)
        else:
            assert got[name] is None


def test_small_numbers_are_exact_and_groups_apart(spark):
    rows = spark.createDataFrame([("a", v) for v in range(100)] + [(None, -5), ("b", None)], "k string, v int")
    got = {r.k: (r.n, r.p50) for r in Q.quantiles(Q.histogram(rows, ["k"], "v"), ["k"], {"p50": 0.5}).collect()}
    assert got == {"a": (100, 49), None: (1, -5)}
