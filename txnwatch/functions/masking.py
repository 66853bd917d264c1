"""PII masking expressions for the Silver layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pseudonym(user_id, salt: str) -> Column:
    """Hex SHA-256 of ``user_id || salt``; a null id stays null."""
    return F.sha2(F.concat(_c(user_id), F.lit(salt)), 256)


def ip_mask(ip, octets: int = 2) -> Column:
    """Keep the first ``octets`` dotted parts: ``10.20.30.40`` -> ``10.20.*.*``.

    Addresses with fewer parts than kept (or null) become null, never an error.
    """
    if not 1 <= octets <= 4:
        raise ValueError("octets must be within 1..4")
    parts = F.split(_c(ip), r"\.")
    kept = [F.get(parts, i) for i in range(octets)]
    pieces = []
    for i, part in enumerate(kept):
        if i:
            pieces.append(F.lit("."))
        pieces.append(part)
    pieces.extend(F.lit(".*") for _ in range(4 - octets))
    return F.concat(*pieces)


def sql_string(value: str) -> str:
    """A Spark SQL string literal for ``value`` (quotes and backslashes escaped)."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
