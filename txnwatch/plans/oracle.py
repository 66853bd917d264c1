"""Independent DuckDB SQL for every catalogued query.

Written from the documented semantics, not generated from the Spark plans.
``TXN_VIEW`` mirrors ``txnwatch.sources.events.transactions_from_events``.
"""

from __future__ import annotations

from txnwatch.config import DEFAULT_SALT
from txnwatch.plans.catalog import WIDE

SALT = DEFAULT_SALT

TXN_VIEW = """
txn AS (
  SELECT
    'TXN-' || CAST(event_id AS VARCHAR) AS transaction_id,
    'U' || CAST(user_id AS VARCHAR) AS user_id,
    'M' || CAST(3001 + CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS VARCHAR) AS merchant_id,
    value * CAST(20.0 AS DOUBLE) AS amount,
    'USD' AS currency,
    ts AS "timestamp",
    [CAST(40.7128 AS DOUBLE), CAST(34.0522 AS DOUBLE), CAST(51.5074 AS DOUBLE),
     CAST(35.6762 AS DOUBLE), CAST(31.2304 AS DOUBLE)][event_id % 5 + 1] AS latitude,
    [CAST(-74.0060 AS DOUBLE), CAST(-118.2437 AS DOUBLE), CAST(-0.1278 AS DOUBLE),
     CAST(139.6503 AS DOUBLE), CAST(121.4737 AS DOUBLE)][event_id % 5 + 1] AS longitude,
    ['New York', 'Los Angeles', 'London', 'Tokyo', 'Shanghai'][event_id % 5 + 1] AS city,
    concat_ws('.', CAST(10 + user_id % 200 AS VARCHAR), CAST(event_id % 256 AS VARCHAR),
              CAST((event_id // 256) % 256 AS VARCHAR), CAST(user_id % 256 AS VARCHAR)) AS ip_address,
    'DEV-' || CAST(user_id AS VARCHAR) AS device_id,
    event_type AS transaction_type,
    CAST(user_id % 3 AS INTEGER) AS kafka_partition,
    event_id AS kafka_offset
  FROM events
),
txs AS (
  SELECT *, CAST(floor(epoch_us("timestamp") / 1000000.0) AS BIGINT) AS sec,
         sha256(user_id || '{salt}') AS user_hash
  FROM txn
)""".replace("{salt}", SALT)

TXN_COLS = ("transaction_id, user_id, merchant_id, amount, currency, \"timestamp\", latitude, "
            "longitude, city, ip_address, device_id, transaction_type, kafka_partition, kafka_offset")


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, p2 = f"radians({lat1})", f"radians({lat2})"
    sphi = f"sin(({p2} - {p1}) / 2)"
    slmb = f"sin((radians({lon2}) - radians({lon1})) / 2)"
    a = f"{sphi} * {sphi} + cos({p1}) * cos({p2}) * {slmb} * {slmb}"
    return f"(CAST(12742.0 AS DOUBLE) * asin(least(CAST(1.0 AS DOUBLE), sqrt({a}))))"


def _with(body: str) -> str:
    return f"WITH {TXN_VIEW}\n{body}"


# ---- rule hit sets (full hit shape: txn columns, user_hash, evidence) ------

def r1_sql(window_minutes: float, threshold: int) -> str:
    w = int(round(window_minutes * 60))
    return f"""r1 AS (
  SELECT * FROM (
    SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY sec
                             RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) AS txn_count
    FROM txs) WHERE txn_count > {threshold})"""


def r4_sql(window_minutes: float, threshold: int) -> str:
    w = int(round(window_minutes * 60))
    return f"""r4 AS (
  SELECT * FROM (
    SELECT *, count(*) OVER (PARTITION BY merchant_id ORDER BY sec
                             RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) AS merchant_txn_count
    FROM txs) WHERE merchant_txn_count > {threshold})"""


def r2_sql(max_distance_km: float, max_interval_minutes: float) -> str:
    return f"""r2 AS (
  SELECT * FROM (
    SELECT *, {haversine('prev_lat', 'prev_lon', 'latitude', 'longitude')} AS distance_km,
           (sec - prev_sec) / 60.0 AS time_diff_minutes
    FROM (
      SELECT *,
        lag(latitude) OVER w AS prev_lat, lag(longitude) OVER w AS prev_lon,
        lag("timestamp") OVER w AS prev_ts, lag(sec) OVER w AS prev_sec
      FROM txs WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", transaction_id))
    WHERE prev_lat IS NOT NULL AND prev_ts IS NOT NULL)
  WHERE distance_km > {float(max_distance_km)} AND time_diff_minutes < {float(max_interval_minutes)})"""


def r3_sql(min_amount: float, start_hour: int, end_hour: int) -> str:
    return f"""r3 AS (
  SELECT * FROM txs
  WHERE amount > {float(min_amount)} AND hour("timestamp") >= {start_hour}
    AND hour("timestamp") < {end_hour})"""


def rules_sql(rules) -> str:
    return ",\n".join([
        r1_sql(rules.r1.window_minutes, rules.r1.threshold),
        r2_sql(rules.r2.max_distance_km, rules.r2.max_interval_minutes),
        r3_sql(rules.r3.min_amount, rules.r3.start_hour, rules.r3.end_hour),
        r4_sql(rules.r4.window_minutes, rules.r4.threshold),
    ])


HIT_COLS = (TXN_COLS + ", user_hash, txn_count, prev_lat, prev_lon, prev_ts, "
            "round(distance_km, 6) AS distance_km, time_diff_minutes, merchant_txn_count, rule_type")


def all_hits_sql(rules) -> str:
    """Union of the four rules in the common hit shape (CTE ``hits``)."""
    null = "CAST(NULL AS {})"
    pad = {
        "txn_count": null.format("BIGINT"), "prev_lat": null.format("DOUBLE"),
        "prev_lon": null.format("DOUBLE"), "prev_ts": null.format("TIMESTAMP"),
        "distance_km": null.format("DOUBLE"), "time_diff_minutes": null.format("DOUBLE"),
        "merchant_txn_count": null.format("BIGINT"),
    }

    def branch(name, tag, have):
        cols = [TXN_COLS, "user_hash"]
        for c in ("txn_count", "prev_lat", "prev_lon", "prev_ts", "distance_km",
                  "time_diff_minutes", "merchant_txn_count"):
            cols.append(c if c in have else f"{pad[c]} AS {c}")
        cols.append(f"'{tag}' AS rule_type")
        return f"SELECT {', '.join(cols)} FROM {name}"

    parts = [
        branch("r1", "VELOCITY_FRAUD", {"txn_count"}),
        branch("r2", "GEO_JUMP", {"prev_lat", "prev_lon", "prev_ts", "distance_km", "time_diff_minutes"}),
        branch("r3", "NIGHT_LARGE", set()),
        branch("r4", "MERCHANT_VELOCITY", {"merchant_txn_count"}),
    ]
    return rules_sql(rules) + ",\nhits AS (\n" + "\nUNION ALL\n".join(parts) + ")"


def _rule_hits(cte: str, evidence: str) -> str:
    return _with(f",\n{cte}\nSELECT {TXN_COLS}, user_hash, {evidence} FROM {cte.split()[0]}")


def _alert_label(rules) -> str:
    by_tag = {"VELOCITY_FRAUD": ("R1", rules.r1), "GEO_JUMP": ("R2", rules.r2),
              "NIGHT_LARGE": ("R3", rules.r3), "MERCHANT_VELOCITY": ("R4", rules.r4)}
    whens = " ".join(
        f"WHEN '{t}' THEN '{rid}: {r.name} — {r.description}'" for t, (rid, r) in by_tag.items())
    return f"CASE rule_type {whens} END"


def alerts_sql(rules) -> str:
    thr = (f"CASE rule_type WHEN 'VELOCITY_FRAUD' THEN {rules.r1.threshold} "
           f"WHEN 'MERCHANT_VELOCITY' THEN {rules.r4.threshold} END")
    about = {"VELOCITY_FRAUD": rules.r1, "GEO_JUMP": rules.r2, "NIGHT_LARGE": rules.r3, "MERCHANT_VELOCITY": rules.r4}
    described = "CASE rule_type " + " ".join(f"WHEN '{t}' THEN '{r.description}'" for t, r in about.items()) + " END"

    def geo(value: float) -> str:
        return f"CASE WHEN rule_type = 'GEO_JUMP' THEN CAST({value} AS DOUBLE) END"

    def night(value: float, dtype: str) -> str:
        return f"CASE WHEN rule_type = 'NIGHT_LARGE' THEN CAST({value} AS {dtype}) END"

    return _with(",\n" + all_hits_sql(rules) + f"""
SELECT 'ALERT-' || rule_type || '-' || transaction_id AS alert_id, rule_type, transaction_id,
       user_hash, amount, "timestamp",
       {_alert_label(rules)} AS detail_rule,
       {described} AS detail_description,
       CAST(CASE rule_type WHEN 'VELOCITY_FRAUD' THEN {rules.r1.window_minutes}
            WHEN 'MERCHANT_VELOCITY' THEN {rules.r4.window_minutes} END AS DOUBLE) AS detail_window_minutes,
       {geo(rules.r2.max_distance_km)} AS detail_max_distance_km,
       {geo(rules.r2.max_interval_minutes)} AS detail_max_interval_minutes,
       {night(rules.r3.min_amount, 'DOUBLE')} AS detail_min_amount,
       {night(rules.r3.start_hour, 'INTEGER')} AS detail_start_hour,
       {night(rules.r3.end_hour, 'INTEGER')} AS detail_end_hour,
       CASE WHEN rule_type = 'VELOCITY_FRAUD' THEN user_hash END AS detail_user_hash,
       CASE WHEN rule_type = 'VELOCITY_FRAUD' THEN txn_count END AS detail_txn_count,
       CASE WHEN rule_type = 'GEO_JUMP' THEN round(distance_km, 2) END AS detail_distance_km,
       CASE WHEN rule_type = 'GEO_JUMP' THEN round(time_diff_minutes, 2) END AS detail_time_diff_minutes,
       CASE WHEN rule_type = 'NIGHT_LARGE' THEN amount END AS detail_amount,
       CASE WHEN rule_type = 'MERCHANT_VELOCITY' THEN merchant_txn_count END AS detail_merchant_txn_count,
       CASE WHEN rule_type = 'MERCHANT_VELOCITY' THEN merchant_id END AS detail_merchant_id,
       CAST({thr} AS INTEGER) AS detail_threshold
FROM hits""")


def _alerts_cte(rules) -> str:
    return all_hits_sql(rules) + """,
alerts AS (
  SELECT 'ALERT-' || rule_type || '-' || transaction_id AS alert_id, rule_type, transaction_id,
         user_hash, amount, "timestamp",
         -- alert raised when the 5-second micro-batch holding the event closes
         make_timestamp(((sec // 5) * 5 + 5) * 1000000) AS alert_time,
         sec
  FROM (SELECT *, CAST(floor(epoch_us("timestamp") / 1000000.0) AS BIGINT) AS sec FROM hits))"""


def oracle_sql() -> dict[str, str]:
    from txnwatch.config import RuleSet

    d = RuleSet()
    w = WIDE
    q: dict[str, str] = {}
    q["transactions"] = _with(f"SELECT {TXN_COLS} FROM txn")
    q["parse_flatten"] = q["transactions"]
    q["bronze_projection"] = q["transactions"]
    q["silver_projection"] = _with(
        "SELECT transaction_id, sha256(user_id || '" + SALT + "') AS user_hash, merchant_id, amount, "
        "currency, \"timestamp\", latitude, longitude, city, "
        "split_part(ip_address, '.', 1) || '.' || split_part(ip_address, '.', 2) || '.*.*' AS ip_mask, "
        "transaction_type, kafka_partition, kafka_offset FROM txn")
    ev1 = "txn_count"
    ev2 = ("prev_lat, prev_lon, prev_ts, round(distance_km, 6) AS distance_km, time_diff_minutes")
    ev4 = "merchant_txn_count"
    q["r1_velocity"] = _rule_hits(r1_sql(d.r1.window_minutes, d.r1.threshold), ev1)
    q["r1_velocity_60m"] = _rule_hits(r1_sql(60, 1), ev1)
    q["r1_velocity_720m"] = _rule_hits(r1_sql(720, 5), ev1)
    q["r2_geo_jump"] = _rule_hits(r2_sql(d.r2.max_distance_km, d.r2.max_interval_minutes), ev2)
    q["r2_geo_jump_60m"] = _rule_hits(r2_sql(1000, 60), ev2)
    q["r3_night_large"] = _rule_hits(r3_sql(d.r3.min_amount, d.r3.start_hour, d.r3.end_hour), "1 AS one").replace(", 1 AS one", "")
    q["r3_night_large_1000"] = _rule_hits(r3_sql(1000, 0, 5), "1 AS one").replace(", 1 AS one", "")
    q["r4_merchant_velocity"] = _rule_hits(r4_sql(d.r4.window_minutes, d.r4.threshold), ev4)
    q["r4_merchant_velocity_30m"] = _rule_hits(r4_sql(30, 3), ev4)
    q["r4_distinct_users_30m"] = _with(f"""
SELECT {TXN_COLS}, user_hash, merchant_user_count FROM (
  SELECT *, count(DISTINCT user_id) OVER (PARTITION BY merchant_id ORDER BY sec
                                          RANGE BETWEEN 1800 PRECEDING AND CURRENT ROW)
            AS merchant_user_count
  FROM txs) WHERE merchant_user_count > 3""")
    q["all_rules"] = _with(",\n" + all_hits_sql(d) + f"\nSELECT {HIT_COLS} FROM hits")
    q["all_rules_wide"] = _with(",\n" + all_hits_sql(w) + f"\nSELECT {HIT_COLS} FROM hits")
    q["alerts"] = alerts_sql(w)
    q["alerts_by_rule"] = _with(",\n" + all_hits_sql(w) +
                                "\nSELECT rule_type, count(*) AS alert_count FROM hits GROUP BY rule_type")
    q["alert_total"] = _with(",\n" + all_hits_sql(w) + "\nSELECT count(*) AS alert_count FROM hits")
    q["distinct_rule_types"] = _with(",\n" + all_hits_sql(w) + "\nSELECT DISTINCT rule_type FROM hits")
    q["latest_alerts"] = _with(",\n" + _alerts_cte(w) + """
SELECT alert_id, rule_type, transaction_id, user_hash, amount, "timestamp"
FROM alerts ORDER BY "timestamp" DESC, alert_id DESC LIMIT 20""")
    q["alerts_since_cursor"] = _with(",\n" + _alerts_cte(w) + """
SELECT alert_id, rule_type, transaction_id, "timestamp", alert_time
FROM alerts WHERE alert_time > TIMESTAMP '2024-01-29 00:00:00'""")
    q["next_cursor"] = _with(",\n" + _alerts_cte(w) + """
SELECT coalesce(max(alert_time), TIMESTAMP '2024-01-29 00:00:00') AS cursor
FROM alerts WHERE alert_time > TIMESTAMP '2024-01-29 00:00:00'""")
    numbered = _with(",\n" + all_hits_sql(w) + """,
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY alert_id, kafka_partition, kafka_offset) AS position
  FROM (SELECT kafka_offset // 500 AS batch_id, 'ALERT-' || rule_type || '-' || transaction_id AS alert_id, kafka_partition, kafka_offset FROM hits)),
rest AS (SELECT * FROM numbered WHERE batch_id > 3 OR (batch_id = 3 AND position > 7))""")
    q["alerts_after_place"] = numbered + """
SELECT batch_id, CAST(position AS INTEGER) AS position, alert_id, kafka_partition, kafka_offset FROM rest"""
    q["next_place"] = numbered + """
SELECT coalesce(max(batch_id), 3) AS batch_id, coalesce(max(position) FILTER (WHERE batch_id = (SELECT max(batch_id) FROM rest)), 7) AS position FROM rest"""
    q["alerts_with_severity"] = _with(",\n" + _alerts_cte(w) + """
SELECT alert_id, rule_type,
  CASE rule_type WHEN 'VELOCITY_FRAUD' THEN 'R1' WHEN 'GEO_JUMP' THEN 'R2'
                 WHEN 'NIGHT_LARGE' THEN 'R3' WHEN 'MERCHANT_VELOCITY' THEN 'R4' END AS rule_id,
  CASE WHEN rule_type IN ('VELOCITY_FRAUD', 'GEO_JUMP') THEN 'high' ELSE 'medium' END AS severity,
  CASE rule_type WHEN 'VELOCITY_FRAUD' THEN 5 WHEN 'GEO_JUMP' THEN 10
                 WHEN 'NIGHT_LARGE' THEN 60 WHEN 'MERCHANT_VELOCITY' THEN 30 END AS response_minutes
FROM alerts""")
    q["alerts_not_in_bronze"] = _with(",\n" + _alerts_cte(w) + """
SELECT alert_id, rule_type, transaction_id FROM alerts a
WHERE NOT EXISTS (SELECT 1 FROM txn b WHERE b.transaction_id = a.transaction_id)""")
    q["bronze_silver_reconcile"] = _with("""
SELECT count(*) AS bronze_rows, count(*) AS silver_rows, count(*) AS matched_rows,
       CAST(0 AS BIGINT) AS missing_in_silver, CAST(0 AS BIGINT) AS missing_in_bronze,
       CAST(0 AS BIGINT) AS hash_mismatches,
       count(*) FILTER (WHERE contains(sha256(user_id || '""" + SALT + """'), user_id)) AS id_leaks,
       false AS silver_has_device_id
FROM txn""")
    q["alert_latency"] = _with(",\n" + _alerts_cte(w) + """,
lat AS (SELECT rule_type, (sec // 5) * 5 + 5 - sec AS lat FROM alerts),
ranked AS (SELECT rule_type, lat,
                  row_number() OVER (PARTITION BY rule_type ORDER BY lat) AS rn,
                  count(*) OVER (PARTITION BY rule_type) AS n FROM lat)
SELECT rule_type, count(*) AS alerts, min(lat) AS min_latency_s, max(lat) AS max_latency_s,
       avg(lat) AS avg_latency_s,
       min(lat) FILTER (WHERE rn >= ceil(0.5 * n)) AS p50_latency_s,
       min(lat) FILTER (WHERE rn >= ceil(0.95 * n)) AS p95_latency_s
FROM ranked GROUP BY rule_type""")
    q["throughput"] = _with("""
, per AS (SELECT date_trunc('second', "timestamp") AS s, count(*) AS n FROM txn GROUP BY 1)
SELECT max(n) AS peak_per_bucket, avg(n) AS mean_per_active_bucket,
       count(*) AS active_buckets, sum(n) AS rows FROM per""")
    q["recall_by_rule"] = _with(",\n" + all_hits_sql(w) + """
SELECT rule_type, count(*) AS expected, count(*) AS found, 1.0::DOUBLE AS recall
FROM (SELECT DISTINCT transaction_id, rule_type FROM hits) GROUP BY rule_type""")
    bl = "(SELECT DISTINCT user_id FROM txn WHERE amount > 1000.0 AND hour(\"timestamp\") < 5)"
    q["blacklist_hits"] = _with(f"""
SELECT transaction_id, user_id, merchant_id, amount, "timestamp" FROM txn
WHERE user_id IN {bl}""")
    q["blacklist_pass"] = _with(f"""
SELECT transaction_id, user_id, merchant_id, amount, "timestamp" FROM txn
WHERE user_id NOT IN {bl}""")

    def windows(key: str, size_s: int, slide_s: int, out: str = "txn_count") -> str:
        k = size_s // slide_s
        return f"""
, starts AS (
  SELECT {key}, ((sec // {slide_s}) - j) * {slide_s} AS ws
  FROM txs, range(0, {k}) r(j))
SELECT make_timestamp(ws * 1000000) AS window_start,
       make_timestamp((ws + {size_s}) * 1000000) AS window_end, {key}, count(*) AS {out}
FROM starts GROUP BY ws, {key}"""

    q["tumbling_user_counts"] = _with(windows("user_id", 300, 300))
    q["sliding_user_counts"] = _with(windows("user_id", 300, 60))
    q["sliding_merchant_counts"] = _with(windows("merchant_id", 60, 10, "merchant_txn_count"))
    q["sliding_user_alerts"] = _with(windows("user_id", 3600, 900).replace(
        "FROM starts GROUP BY ws, user_id",
        "FROM starts GROUP BY ws, user_id HAVING count(*) > 2").replace(
        "count(*) AS txn_count", "count(*) AS txn_count, 2 AS threshold"))
    q["interval_pairs"] = _with(f"""
SELECT user_id, transaction_id, prev_transaction_id, "timestamp", prev_ts, gap_seconds,
       round(distance_km, 2) AS distance_km
FROM (
  SELECT user_id, transaction_id, prev_transaction_id, "timestamp", prev_ts,
         sec - prev_sec AS gap_seconds,
         {haversine('prev_lat', 'prev_lon', 'latitude', 'longitude')} AS distance_km
  FROM (
    SELECT *, lag(transaction_id) OVER w AS prev_transaction_id, lag("timestamp") OVER w AS prev_ts,
           lag(sec) OVER w AS prev_sec, lag(latitude) OVER w AS prev_lat,
           lag(longitude) OVER w AS prev_lon
    FROM txs WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", transaction_id)))
WHERE prev_ts IS NOT NULL AND gap_seconds BETWEEN 0 AND 600 AND distance_km > 1000.0""")
    q["stream_pairs"] = _with(f"""
SELECT user_id, transaction_id, prev_transaction_id, "timestamp", prev_ts, gap_seconds, round(km, 6) AS distance_km
FROM (SELECT t.user_id, t.transaction_id, p.transaction_id AS prev_transaction_id, t."timestamp", p."timestamp" AS prev_ts, t.sec - p.sec AS gap_seconds,
             {haversine('p.latitude', 'p.longitude', 't.latitude', 't.longitude')} AS km
      FROM txs t JOIN txs p ON t.user_id = p.user_id AND t.sec - p.sec BETWEEN 0 AND 3600
           AND (t.sec > p.sec OR (t.kafka_partition, t.kafka_offset) > (p.kafka_partition, p.kafka_offset)))
WHERE round(km, 6) > 1000""")
    q["r1_velocity_720m_prefix"] = q["r1_velocity_720m"]
    q["r4_merchant_velocity_30m_prefix"] = q["r4_merchant_velocity_30m"]

    def counting(tag: str, key: str, minutes: int, threshold: int) -> str:
        frame = f"count(*) OVER (PARTITION BY {key} ORDER BY sec RANGE BETWEEN {60 * minutes} PRECEDING AND CURRENT ROW)"
        return f"SELECT {TXN_COLS}, '{tag}' AS rule_type, {frame} AS evidence FROM txs QUALIFY evidence > {threshold}"

    q["registry_rules"] = _with("\nUNION ALL\n".join([
        counting("VELOCITY_FRAUD", "user_id", 60, 1), counting("DAILY_VELOCITY", "user_id", 1440, 3),
        f"""SELECT {TXN_COLS}, 'NIGHT_LARGE' AS rule_type, NULL AS evidence FROM txs WHERE amount > 1000 AND hour("timestamp") < 5""",
        counting("MERCHANT_VELOCITY", "merchant_id", 30, 3), counting("DEVICE_VELOCITY", "device_id", 120, 2)]))
    q["r4_distinct_users_sketch"] = _with("""
, b AS (SELECT DISTINCT merchant_id, user_id, sec // 600 AS b FROM txs),
m AS (SELECT DISTINCT merchant_id, b FROM b)
SELECT m.merchant_id, (m.b + 1) * 600 AS bucket_end, count(DISTINCT b.user_id) AS merchant_user_count
FROM m JOIN b ON m.merchant_id = b.merchant_id AND b.b BETWEEN m.b - 5 AND m.b GROUP BY m.merchant_id, m.b HAVING count(DISTINCT b.user_id) > 2""")
    # Latencies by their seven leading binary digits, the 50th, 95th and 99th part of the sorted ones.
    q["alert_latency_sketch"] = _with(",\n" + all_hits_sql(w) + """,
l AS (SELECT rule_type, epoch_us(make_timestamp((epoch_us("timestamp") // 5000000 * 5 + 5) * 1000000)) - epoch_us("timestamp") AS micros FROM hits),
c AS (SELECT rule_type, micros >> greatest(length(bin(micros)) - 7, 0) << greatest(length(bin(micros)) - 7, 0) AS low FROM l),
o AS (SELECT *, row_number() OVER (PARTITION BY rule_type ORDER BY low) AS place, count(*) OVER (PARTITION BY rule_type) AS n FROM c)
SELECT rule_type, count(*) AS n, min(low) FILTER (WHERE place >= ceil(0.5 * n)) AS p50_micros,
       min(low) FILTER (WHERE place >= ceil(0.95 * n)) AS p95_micros, min(low) FILTER (WHERE place >= ceil(0.99 * n)) AS p99_micros
FROM o GROUP BY rule_type""")
    iso = "strftime(make_timestamp((sec - {}) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"
    q["alert_windows"] = _with(",\n" + _alerts_cte(w) + f"""
SELECT alert_id, CASE rule_type WHEN 'VELOCITY_FRAUD' THEN {iso.format(3600)} ELSE {iso.format(1800)} END AS window_start, {iso.format(0)} AS window_end
FROM alerts WHERE rule_type IN ('VELOCITY_FRAUD', 'MERCHANT_VELOCITY')""")
    collide = "'TXN-' || CAST(event_id // 1000 AS VARCHAR) AS transaction_id"
    q["alerts_lost_colliding"] = _with(",\n" + all_hits_sql(w) + """
SELECT rule_type, transaction_id, kafka_partition, kafka_offset FROM hits WHERE hour("timestamp") = 3""").replace(
        "'TXN-' || CAST(event_id AS VARCHAR) AS transaction_id", collide)
    # R2 (1,000 km, an hour) after each of three batches dealt by offset, and how one state differs from the next.
    q["r2_change_log"] = _with(f"""
, seen AS (SELECT txs.*, b FROM txs JOIN range(0, 3) r(b) ON kafka_offset % 3 <= b),
near AS (SELECT *, lag(sec) OVER w AS prev_sec, lag(latitude) OVER w AS prev_lat, lag(longitude) OVER w AS prev_lon
         FROM seen WINDOW w AS (PARTITION BY b, user_id ORDER BY "timestamp", transaction_id)),
state AS (SELECT b, kafka_partition, kafka_offset, transaction_id, prev_sec, {haversine('prev_lat', 'prev_lon', 'latitude', 'longitude')} AS km
          FROM near WHERE prev_sec IS NOT NULL AND sec - prev_sec < 3600),
hit AS (SELECT b, kafka_partition, kafka_offset, transaction_id, prev_sec, round(km, 6) AS distance_km FROM state WHERE km > 1000)
SELECT a.b AS batch_id, 'insert' AS op, a.kafka_partition, a.kafka_offset, a.transaction_id, a.prev_sec, a.distance_km
FROM hit a LEFT JOIN hit p ON p.b = a.b - 1 AND p.kafka_offset = a.kafka_offset WHERE p.b IS NULL OR p.prev_sec <> a.prev_sec OR p.distance_km <> a.distance_km
UNION ALL
SELECT p.b + 1, 'retract', p.kafka_partition, p.kafka_offset, p.transaction_id, NULL, NULL
FROM hit p LEFT JOIN hit a ON a.b = p.b + 1 AND p.kafka_offset = a.kafka_offset WHERE p.b < 2 AND a.b IS NULL""")
    q["replayed_alerts"] = _with(",\n" + all_hits_sql(w) + """
SELECT 'ALERT-' || rule_type || '-' || transaction_id AS alert_id, rule_type, user_hash, amount, kafka_partition, kafka_offset FROM hits""")
    q["replayed_latency"] = _with(",\n" + all_hits_sql(w) + """
SELECT rule_type, count(*) AS n, true AS measured, true AS within_error FROM hits GROUP BY rule_type""")
    # Windows whose end the watermark, ten minutes behind the newest event, has reached.
    newest = "(SELECT max(date_trunc('millisecond', \"timestamp\")) FROM txn)"
    for name, args in (("stream_tumbling_user_counts", ("user_id", 300, 300)), ("stream_sliding_merchant_counts", ("merchant_id", 1800, 600))):
        head, tail = windows(*args).split("\nSELECT", 1)
        q[name] = _with(f"{head}, w AS (SELECT{tail})\nSELECT * FROM w WHERE window_end <= {newest} - INTERVAL 10 MINUTE")
    # Buckets of two hours that the watermark has reached; R1 over 60 minutes, R2 within 60.
    q["stream_user_rules"] = _with(f"""
, scored AS (
  SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS n,
         lag(sec) OVER w AS p_sec, lag("timestamp") OVER w AS p_ts, {haversine('lag(latitude) OVER w', 'lag(longitude) OVER w', 'latitude', 'longitude')} AS km
  FROM txs WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", transaction_id, kafka_partition, kafka_offset)),
closed AS (SELECT * FROM scored WHERE make_timestamp((sec // 7200 + 1) * 7200 * 1000000) <= {newest} - INTERVAL 10 MINUTE)
SELECT user_id, transaction_id, kafka_partition, kafka_offset, epoch_us("timestamp") AS event_micros, 'VELOCITY_FRAUD' AS rule_type, n AS txn_count,
       CAST(NULL AS BIGINT) AS prev_micros, CAST(NULL AS DOUBLE) AS distance_km, CAST(NULL AS DOUBLE) AS time_diff_minutes FROM closed WHERE n > 1
UNION ALL
SELECT user_id, transaction_id, kafka_partition, kafka_offset, epoch_us("timestamp"), 'GEO_JUMP', NULL, epoch_us(p_ts), round(km, 6), (sec - p_sec) / CAST(60.0 AS DOUBLE)
FROM closed WHERE p_ts IS NOT NULL AND km > 1000 AND (sec - p_sec) / CAST(60.0 AS DOUBLE) < 60""")
    q["newest_silver_rows"] = _with("""
SELECT transaction_id, sha256(user_id || '""" + SALT + """') AS user_hash, merchant_id, amount,
       split_part(ip_address, '.', 1) || '.' || split_part(ip_address, '.', 2) || '.*.*' AS ip_mask,
       kafka_partition, kafka_offset
FROM txn ORDER BY kafka_partition DESC, kafka_offset DESC LIMIT 3""")
    q["newest_bronze_rows"] = _with("""
SELECT transaction_id, user_id, merchant_id, amount, ip_address, device_id, kafka_partition, kafka_offset
FROM txn ORDER BY kafka_partition DESC, kafka_offset DESC LIMIT 3""")
    q["all_rules_r3_only"] = _with(",\n" + all_hits_sql(w) + f"\nSELECT {HIT_COLS} FROM hits WHERE rule_type = 'NIGHT_LARGE'")
    q["all_rules_off"] = _with(",\n" + all_hits_sql(w) + f"\nSELECT {HIT_COLS} FROM hits WHERE false")
    q["rejects"] = _with("""
, damaged AS (SELECT *, kafka_offset % 10 AS m FROM txn)
SELECT kafka_partition, kafka_offset, CASE WHEN m <> 1 THEN transaction_id END AS transaction_id,
       CASE WHEN m = 2 THEN user_id END AS user_id, CASE WHEN m <> 1 THEN amount END AS amount,
       CASE WHEN m = 3 THEN "timestamp" END AS "timestamp"
FROM damaged WHERE m IN (1, 2, 3)""")
    q["blacklist_merchant_hits"] = _with("""
SELECT transaction_id, user_id, merchant_id, amount, "timestamp" FROM txn WHERE merchant_id = 'M3002'""")
    q["blacklist_ip_hits"] = _with("""
SELECT transaction_id, ip_address, amount, "timestamp" FROM txn
WHERE ip_address IN (SELECT ip_address FROM txn WHERE amount > 1500.0 AND hour("timestamp") < 5)""")
    q["blacklist_bloom_hits"] = q["blacklist_ip_hits"]
    q["blacklist_bloom_pass"] = q["blacklist_ip_hits"].replace("ip_address IN", "ip_address NOT IN")
    q["recall_by_label"] = _with(",\n" + all_hits_sql(w) + """,
lab AS (
  SELECT transaction_id, 'NIGHT_LARGE' AS rule_type FROM txn WHERE amount > 1000.0 AND hour("timestamp") < 6
  UNION ALL
  SELECT transaction_id, 'VELOCITY_FRAUD' FROM (
    SELECT transaction_id, count(*) OVER h AS n,
           row_number() OVER (h ORDER BY "timestamp" DESC, transaction_id DESC) AS newest
    FROM txn WINDOW h AS (PARTITION BY user_id, date_trunc('hour', "timestamp")))
  WHERE n > 1 AND newest = 1),
got AS (SELECT DISTINCT transaction_id, rule_type FROM hits)
SELECT lab.rule_type, count(*) AS expected, count(got.transaction_id) AS found,
       CAST(count(got.transaction_id) AS DOUBLE) / count(*) AS recall
FROM lab LEFT JOIN got ON lab.transaction_id = got.transaction_id AND lab.rule_type = got.rule_type
GROUP BY lab.rule_type""")
    q["alerts_in_lost_hour"] = _with(",\n" + _alerts_cte(w) + """
SELECT alert_id, rule_type, transaction_id FROM alerts a
WHERE NOT EXISTS (SELECT 1 FROM txn b WHERE b.transaction_id = a.transaction_id AND hour(b."timestamp") <> 3)""")
    q["bronze_silver_gaps"] = _with("""
, h AS (SELECT user_id, hour("timestamp") <> 3 AS in_bronze, hour("timestamp") <> 4 AS in_silver FROM txn)
SELECT count(*) FILTER (WHERE in_bronze) AS bronze_rows, count(*) FILTER (WHERE in_silver) AS silver_rows,
       count(*) FILTER (WHERE in_bronze AND in_silver) AS matched_rows,
       count(*) FILTER (WHERE NOT in_silver) AS missing_in_silver,
       count(*) FILTER (WHERE NOT in_bronze) AS missing_in_bronze,
       count(*) FILTER (WHERE in_bronze AND in_silver AND length(sha256(user_id || '""" + SALT + """')) <> 64) AS hash_mismatches,
       count(*) FILTER (WHERE in_bronze AND in_silver AND contains(sha256(user_id || '""" + SALT + """'), user_id)) AS id_leaks,
       false AS silver_has_device_id
FROM h""")
    return q
