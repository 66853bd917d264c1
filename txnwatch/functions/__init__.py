"""Column helpers built only from Spark's native expressions (no UDFs)."""

from txnwatch.functions.geo import haversine_km, haversine_sql
from txnwatch.functions.masking import ip_mask, pseudonym
from txnwatch.functions.time import epoch_seconds, epoch_seconds_sql, quote

__all__ = ["haversine_km", "haversine_sql", "ip_mask", "pseudonym", "epoch_seconds", "epoch_seconds_sql", "quote"]
