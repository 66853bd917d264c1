"""JOIN-3: R2 as a relation between two transactions of one user.

Each transaction is joined, as-of, to the same user's previous transaction
(ordered by time, then id) when that one is at most ``max_gap_seconds`` whole
seconds earlier and more than ``min_distance_km`` away.

The relation is deliberately the *previous-row* one: an interval join that
pairs every transaction with every earlier one in the band emits a number of
rows quadratic in a user's transactions per band, which a hot account (a
third of all rows) turns into an explosion.  The as-of form is computed by
the bucketed ``previous_within`` (a lag over ``(user, time bucket)``), so a hot
user is split by time and no pair is ever enumerated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnwatch.functions.geo import haversine_sql
from txnwatch.functions.time import epoch_seconds_sql
from txnwatch.operators.trailing import previous_within

PAIR_COLUMNS = ("user_id", "transaction_id", "prev_transaction_id", "timestamp", "prev_ts",
                "gap_seconds", "distance_km")


def geo_pairs(df: DataFrame, max_gap_seconds: int, min_distance_km: float) -> DataFrame:
    base = df.select("user_id", "transaction_id", "timestamp", "latitude", "longitude")
    prev = previous_within(base, "user_id", "timestamp", order=["transaction_id"],
                           carry=["transaction_id", "timestamp", "latitude", "longitude"],
                           max_gap_seconds=int(max_gap_seconds) + 1, prefix="p_")
    gap = f"({epoch_seconds_sql(prev, 'timestamp')} - {epoch_seconds_sql(prev, 'p_timestamp')})"
    dist = haversine_sql("p_latitude", "p_longitude", "latitude", "longitude")
    scored = prev.where("p_timestamp IS NOT NULL").selectExpr(
        "user_id", "transaction_id", "p_transaction_id AS prev_transaction_id", "`timestamp`",
        "p_timestamp AS prev_ts", f"{gap} AS gap_seconds", f"{dist} AS distance_km")
    return (scored.where(f"gap_seconds BETWEEN 0 AND {int(max_gap_seconds)} "
                         f"AND distance_km > {float(min_distance_km)!r}D")
                  .selectExpr(*PAIR_COLUMNS[:-1], "round(distance_km, 2) AS distance_km"))
