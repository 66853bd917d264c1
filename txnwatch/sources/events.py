"""Map the driver's ``events`` table onto the transaction model.

Every expression here has a twin in the DuckDB oracle
(``txnwatch.plans.oracle.TXN_VIEW``); keep the two identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnwatch.sources.tables import read_parquet

# The five city locations (name, latitude, longitude), chosen
# per transaction by event_id % 5 in this order.
CITIES = (
    ("New York", 40.7128, -74.0060),
    ("Los Angeles", 34.0522, -118.2437),
    ("London", 51.5074, -0.1278),
    ("Tokyo", 35.6762, 139.6503),
    ("Shanghai", 31.2304, 121.4737),
)
AMOUNT_SCALE = 20.0
MERCHANT_BASE = 3001
MERCHANTS = 5
PARTITIONS = 3

TXN_COLUMNS = ("transaction_id", "user_id", "merchant_id", "amount", "currency", "timestamp",
               "latitude", "longitude", "city", "ip_address", "device_id", "transaction_type",
               "kafka_partition", "kafka_offset")


def _sql_list(values) -> str:
    return "array(" + ", ".join(repr(v) if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"
                                for v in values) + ")"


def _view_exprs() -> list[str]:
    """The view as SQL expressions (one analysis pass, mirrors the oracle)."""
    pick = "element_at({}, CAST(event_id % {} AS INT) + 1)"
    n = len(CITIES)
    return [
        "concat('TXN-', CAST(event_id AS STRING)) AS transaction_id",
        "concat('U', CAST(user_id AS STRING)) AS user_id",
        f"concat('M', CAST({MERCHANT_BASE} + CAST(get_json_object(props, '$.k') AS INT) % {MERCHANTS}"
        " AS STRING)) AS merchant_id",
        f"value * CAST({AMOUNT_SCALE!r} AS DOUBLE) AS amount",
        "'USD' AS currency",
        "ts AS timestamp",
        pick.format(_sql_list(c[1] for c in CITIES), n) + " AS latitude",
        pick.format(_sql_list(c[2] for c in CITIES), n) + " AS longitude",
        pick.format(_sql_list(c[0] for c in CITIES), n) + " AS city",
        "concat_ws('.', CAST(10 + user_id % 200 AS STRING), CAST(event_id % 256 AS STRING), "
        "CAST((event_id DIV 256) % 256 AS STRING), CAST(user_id % 256 AS STRING)) AS ip_address",
        "concat('DEV-', CAST(user_id AS STRING)) AS device_id",
        "event_type AS transaction_type",
        f"CAST(user_id % {PARTITIONS} AS INT) AS kafka_partition",
        "event_id AS kafka_offset",
    ]


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Narrow projection of ``events`` into the 14 transaction columns (F2 layout)."""
    return events.selectExpr(*_view_exprs())


EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transaction view over ``<sf_dir>/events.parquet`` (whole table)."""
    return transactions_from_events(
        read_parquet(spark, f"{sf_dir}/events.parquet", schema=EVENTS_SCHEMA))
