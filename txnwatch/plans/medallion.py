"""Bronze (raw, lineage-stamped) and Silver (PII-masked) projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.functions.masking import ip_mask, pseudonym
from txnwatch.schemas import BRONZE_COLUMNS

FLAT_COLUMNS = BRONZE_COLUMNS[:-1]


def bronze(parsed: DataFrame, ingest_time: Column | None = None) -> DataFrame:
    """PRJ-4/5: the 15 Bronze columns; values untouched, ``ingest_time`` stamped.

    Pass one literal stamp per micro-batch so Bronze and Silver (and a replay)
    agree; the default is the query's ``current_timestamp()``.
    """
    stamp = ingest_time if ingest_time is not None else F.current_timestamp()
    return parsed.select(*FLAT_COLUMNS, stamp.alias("ingest_time"))


def silver(bronze_df: DataFrame, salt: str, octets: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-6..9: pseudonymise the account, mask the address, drop the device.

    ``keep`` names extra (layout) columns to carry through after the 14.
    """
    replaced = {
        "user_id": pseudonym("user_id", salt).alias("user_hash"),
        "ip_address": ip_mask("ip_address", octets).alias("ip_mask"),
    }
    out = []
    for name in BRONZE_COLUMNS:
        if name == "device_id":
            continue
        out.append(replaced.get(name, name))
    return bronze_df.select(*out, *keep)
