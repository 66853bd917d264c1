"""JOIN-3 on a live stream: every transaction with each earlier one of its user inside a time band.

Two watermarked sides meet on the user and a time bucket as wide as the band; the earlier side goes into its own bucket and
the next, so each pair meets in exactly one, the later row's. A busy user is thereby split by time, and a task holds no more
than the rows of two bands. The band on the event times lets Spark drop state that no later row can reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions.geo import haversine_sql

PAIR_COLUMNS = ("user_id", "transaction_id", "prev_transaction_id", "timestamp", "prev_ts", "gap_seconds", "distance_km")
_IDENTITY = ("kafka_partition", "kafka_offset")


def band_pairs(later: DataFrame, earlier: DataFrame, band_seconds: int, min_distance_km: float) -> DataFrame:
    """Pairs of one user at most ``band_seconds`` whole seconds and more than ``min_distance_km`` apart.

    Both frames hold transactions (the same ones, read twice) with a TIMESTAMP ``timestamp``, watermarked if they are
    streams. Rows of one second count as ordered by their place in the broker; a row without position pairs with none,
    nor does one without user.
    """
    band = int(band_seconds)
    width = max(band, 1)
    sec = "unix_seconds(`timestamp`)"
    a = later.selectExpr("user_id", "transaction_id", "`timestamp`", "latitude", "longitude", *_IDENTITY, f"floor({sec} / {width}) AS bucket")
    b = earlier.selectExpr(
        "user_id AS p_user", "transaction_id AS prev_transaction_id", "`timestamp` AS prev_ts", "latitude AS p_lat", "longitude AS p_lon",
        *[f"{c} AS p_{c}" for c in _IDENTITY], f"explode(array(floor({sec} / {width}), floor({sec} / {width}) + 1)) AS p_bucket")
    gap = "(unix_seconds(`timestamp`) - unix_seconds(prev_ts))"
    order = " AND ".join([f"{gap} BETWEEN 0 AND {band}",
                          f"({gap} > 0 OR struct(kafka_partition, kafka_offset) > struct(p_kafka_partition, p_kafka_offset))",
                          # in event times, for the state's sake: seconds are whole, so a band may be a second longer
                          f"`timestamp` >= prev_ts - INTERVAL 1 SECOND AND `timestamp` <= prev_ts + INTERVAL {band + 1} SECONDS"])
    met = a.join(b, (a["user_id"] == b["p_user"]) & (a["bucket"] == b["p_bucket"]) & F.expr(order), "inner")
    pairs = met.selectExpr("user_id", "transaction_id", "prev_transaction_id", "`timestamp`", "prev_ts", f"{gap} AS gap_seconds",
                           f"round({haversine_sql('p_lat', 'p_lon', 'latitude', 'longitude')}, 6) AS distance_km")
    return pairs.where(f"distance_km > {float(min_distance_km)!r}D")

