"""Fixture rows in the flat rule-input shape (F1) and small utilities."""

import os
from datetime import datetime, timedelta

from pyspark.sql.types import (
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF001 = "/root/testdata/sf0.001"

F1 = StructType([
    StructField("transaction_id", StringType()),
    StructField("user_id", StringType()),
    StructField("merchant_id", StringType()),
    StructField("amount", DoubleType()),
    StructField("timestamp", TimestampType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("ip_address", StringType()),
    StructField("device_id", StringType()),
    StructField("transaction_type", StringType()),
])

NEW_YORK = (40.7128, -74.0060)
TOKYO = (35.6762, 139.6503)
BASE = datetime(2024, 1, 15, 12, 0, 0)


def txn(tid, ts, user="U1001", merchant="M3001", amount=100.0, where=NEW_YORK,
        ip="192.168.1.1", device="DEV-001", kind="purchase"):
    lat, lon = where if where is not None else (None, None)
    return (tid, user, merchant, float(amount), ts, lat, lon, ip, device, kind)


def frame(spark, rows):
    return spark.createDataFrame(rows, F1)


def minutes(m):
    return timedelta(minutes=m)


def seconds(s):
    return timedelta(seconds=s)


def ids(df, col="transaction_id"):
    return sorted(r[0] for r in df.select(col).collect())
