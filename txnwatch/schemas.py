"""Declared schemas: wire record, Kafka-like envelope, Bronze, Silver, alert."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LOCATION = StructType([
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("city", StringType(), True),
])

# One JSON object per message.  ``timestamp`` is ISO-8601 text on the wire.
WIRE = StructType([
    StructField("transaction_id", StringType(), False),
    StructField("user_id", StringType(), False),
    StructField("merchant_id", StringType(), False),
    StructField("amount", DoubleType(), False),
    StructField("currency", StringType(), False),
    StructField("timestamp", StringType(), False),
    StructField("location", LOCATION, True),
    StructField("ip_address", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("transaction_type", StringType(), True),
])

# Fields the wire schema declares NOT NULL; a record missing any is rejected.
REQUIRED = ("transaction_id", "user_id", "merchant_id", "amount", "currency", "timestamp")

# What a broker hands over per record (file-based tests use the same layout).
ENVELOPE = StructType([
    StructField("value", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
])

BRONZE = StructType([
    StructField("transaction_id", StringType(), False),
    StructField("user_id", StringType(), False),
    StructField("merchant_id", StringType(), False),
    StructField("amount", DoubleType(), False),
    StructField("currency", StringType(), True),
    StructField("timestamp", TimestampType(), False),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("city", StringType(), True),
    StructField("ip_address", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("transaction_type", StringType(), True),
    StructField("kafka_partition", IntegerType(), True),
    StructField("kafka_offset", LongType(), True),
    StructField("ingest_time", TimestampType(), True),
])

SILVER = StructType([
    StructField("transaction_id", StringType(), False),
    StructField("user_hash", StringType(), False),
    StructField("merchant_id", StringType(), False),
    StructField("amount", DoubleType(), False),
    StructField("currency", StringType(), True),
    StructField("timestamp", TimestampType(), False),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("city", StringType(), True),
    StructField("ip_mask", StringType(), True),
    StructField("transaction_type", StringType(), True),
    StructField("kafka_partition", IntegerType(), True),
    StructField("kafka_offset", LongType(), True),
    StructField("ingest_time", TimestampType(), True),
])

ALERT = StructType([
    StructField("alert_id", StringType(), False),
    StructField("rule_type", StringType(), False),
    StructField("transaction_id", StringType(), False),
    StructField("user_hash", StringType(), False),
    StructField("amount", DoubleType(), False),
    StructField("timestamp", TimestampType(), False),
    StructField("trigger_detail", StringType(), True),
    StructField("alert_time", TimestampType(), False),
])

BRONZE_COLUMNS = tuple(f.name for f in BRONZE.fields)
SILVER_COLUMNS = tuple(f.name for f in SILVER.fields)
ALERT_COLUMNS = tuple(f.name for f in ALERT.fields)
