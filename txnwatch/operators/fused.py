"""R1 and R2 over one shared ``(user, time bucket)`` exchange.

Both rules are keyed by account, so ``apply_all_rules`` scores them together:
each row's payload crosses the shuffle once instead of once per rule.

The bucket width ``D`` is the larger of the two look-backs (R1's window W and
R2's gap bound G), and every row is emitted as up to three copies:

* copy 0, the row itself, into its bucket ``b``;
* copy 1, a narrow marker into ``b + 1`` (key, time, id, position) when the
  row can still matter there: its second plus ``max(W, G)`` reaches the next
  bucket.  Markers are therefore a time-suffix of bucket ``b``, so the true
  predecessor of any row of ``b + 1`` that is within G is present;
* copy 2, an expiry event at ``sec + W + 1``, in ``b`` when the row leaves R1's
  frame before its bucket ends (only possible when ``D > W``), else in
  ``b + 1`` next to its marker.

R1's count is a running sum (+1 per row at its own second, +1 per marker
whose row is still in R1's frame when the next bucket starts, -1 per expiry
event at ``sec + W + 1`` in whichever of the two buckets that second falls);
R2's previous row is the last preceding row or marker (an incremental
``IGNORE NULLS`` frame).  Both windows use the same sort order, so the shared
partition is sorted once.  Both are exact, and equal the separate operators.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from txnwatch.config import TAG_GEO_JUMP, TAG_VELOCITY
from txnwatch.functions.geo import haversine_sql
from txnwatch.functions.time import epoch_seconds_sql, quote
from txnwatch.operators.trailing import spread

_SEC, _BKT, _COPY, _T, _W = "__sec", "__bkt", "__copy", "__t", "__w"


def velocity_and_geo_jump(df: DataFrame, window_minutes: float, threshold: int,
                          max_distance_km: float, max_interval_minutes: float, part_bytes: int | None = None) -> DataFrame:
    """Hits of R1 and R2 with ``rule_type`` and each rule's evidence (the other
    rule's evidence null), in the hit shape of ``apply_all_rules``."""
    w = int(round(float(window_minutes) * 60))
    g = math.ceil(float(max_interval_minutes) * 60)
    width = max(w, g + 1, 1)
    reach = max(w, g)
    cols = df.columns
    sec = epoch_seconds_sql(df, "timestamp")
    doubled = df.selectExpr(*map(quote, cols), f"{sec} AS {_SEC}",
                            f"explode(array(0, 1, 2)) AS {_COPY}")
    end = f"(floor({_SEC} / {width}) + 1) * {width}"        # first second of the next bucket
    marker = f"{_SEC} + {reach} >= {end}"
    # expiry event: inside the own bucket, or in the next one next to its marker
    # A marker counts for R1 only while the row is still in R1's frame when the
    # next bucket starts; only then does it need an expiry event there (and not
    # at all if that falls past the next bucket).
    r1_marker = f"{_SEC} + {w} >= {end}"
    needed = (f"{_COPY} = 0 OR ({_COPY} = 1 AND {marker}) "
              f"OR ({_COPY} = 2 AND ({_SEC} + {w + 1} < {end} "
              f"OR ({r1_marker} AND {_SEC} + {w + 1} < {end} + {width})))")
    bucket = (f"CASE {_COPY} WHEN 0 THEN floor({_SEC} / {width}) WHEN 1 THEN floor({_SEC} / {width}) + 1 "
              f"ELSE floor(({_SEC} + {w + 1}) / {width}) END AS {_BKT}")
    ties = [c for c in ("kafka_partition", "kafka_offset") if c in cols]
    marker_keep = {"user_id", "transaction_id", "timestamp", "latitude", "longitude", *ties}
    shaped = doubled.where(needed).selectExpr(
        *[quote(c) if c == "user_id" else
          (f"CASE WHEN {_COPY} <= 1 THEN {quote(c)} END AS {quote(c)}" if c in marker_keep else
           f"CASE WHEN {_COPY} = 0 THEN {quote(c)} END AS {quote(c)}") for c in cols],
        _SEC, _COPY, bucket,
        f"CASE WHEN {_COPY} = 2 THEN {_SEC} + {w + 1} ELSE {_SEC} END AS {_T}",
        f"CASE {_COPY} WHEN 0 THEN 1 WHEN 1 THEN CASE WHEN {r1_marker} THEN 1 ELSE 0 END "
        f"ELSE -1 END AS {_W}")
    # One sort order serves both windows: (t, time, id).  Rows and markers sit
    # at their own second, expiry events (null time and id) at sec + W + 1.
    part = f"PARTITION BY user_id, {_BKT}"
    prev = (f"last(CASE WHEN {_COPY} <= 1 THEN named_struct('lat', latitude, 'lon', longitude, "
            f"'ts', `timestamp`, 'sec', {_SEC}) END, true) OVER ({part} ORDER BY {_T}, "
            f"{', '.join(['`timestamp`', 'transaction_id', *ties])} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS __prev")
    count = (f"CAST(sum({_W}) OVER ({part} ORDER BY {_T} RANGE BETWEEN UNBOUNDED PRECEDING AND "
             f"CURRENT ROW) AS BIGINT) AS txn_count")
    scored = spread(shaped, ["user_id", _BKT], part_bytes=part_bytes).selectExpr("*", prev).selectExpr("*", count).where(f"{_COPY} = 0").selectExpr(
        *map(quote, cols), "txn_count", "__prev.lat AS prev_lat", "__prev.lon AS prev_lon",
        "__prev.ts AS prev_ts", f"({_SEC} - __prev.sec) / 60.0D AS time_diff_minutes")
    scored = scored.selectExpr(
        "*", f"CASE WHEN prev_lat IS NOT NULL AND prev_ts IS NOT NULL THEN "
             f"{haversine_sql('prev_lat', 'prev_lon', 'latitude', 'longitude')} END AS distance_km")
    r1 = f"txn_count > {int(threshold)}"
    r2 = (f"prev_lat IS NOT NULL AND prev_ts IS NOT NULL AND "
          f"distance_km > {float(max_distance_km)!r}D AND "
          f"time_diff_minutes < {float(max_interval_minutes)!r}D")
    tagged = scored.where(f"({r1}) OR ({r2})").selectExpr(
        "*", f"explode(filter(array(CASE WHEN {r1} THEN '{TAG_VELOCITY}' END, "
             f"CASE WHEN {r2} THEN '{TAG_GEO_JUMP}' END), x -> x IS NOT NULL)) AS rule_type")
    is_r1, is_r2 = f"rule_type = '{TAG_VELOCITY}'", f"rule_type = '{TAG_GEO_JUMP}'"
    return tagged.selectExpr(
        *map(quote, cols),
        f"CASE WHEN {is_r1} THEN txn_count END AS txn_count",
        *[f"CASE WHEN {is_r2} THEN {c} END AS {c}"
          for c in ("prev_lat", "prev_lon", "prev_ts", "distance_km", "time_diff_minutes")],
        "rule_type")
