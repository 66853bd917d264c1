"""AGG-7 with mergeable sketches: whole numbers counted in buckets that are 1/64 of their value wide.

A bucket is a number's sign and seven leading binary digits, so a group has at most some 7,400 of them whatever its size, two sketches are
merged by adding counts, and a quantile read from one lies at most 1/64 of itself nearer to zero than the exact one. Numbers
below 128 are counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions.time import quote

DIGITS = 7


def histogram(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The sketch: ``keys``, ``bucket`` (its number nearest to zero) and ``n``. Null values are left out, null keys are a key."""
    v = quote(value)
    shift = f"greatest(length(bin(abs({v}))) - {DIGITS}, 0)"
    bucket = f"CAST(sign({v}) AS BIGINT) * shiftleft(shiftright(abs({v}), {shift}), {shift}) AS bucket"
    return df.where(f"{v} IS NOT NULL").selectExpr(*map(quote, keys), bucket).groupBy(*map(quote, keys), "bucket").agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketch of each of ``keys`` from sketches of finer groups (batches, tasks, tables)."""
    return sketches.groupBy(*map(quote, keys), "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """A row for each of ``keys``: ``n``, and for each name in ``shares`` the least bucket that the share of the rows reaches."""
    by = ", ".join(map(quote, keys))
    spec = f"{'PARTITION BY ' + by if by else ''} ORDER BY bucket"
    total = f"sum(n) OVER ({'PARTITION BY ' + by if by else ''})"
    ranked = sketch.selectExpr("*", f"sum(n) OVER ({spec} ROWS UNBOUNDED PRECEDING) AS __upto", f"{total} AS __all")
    least = [F.expr(f"min(CASE WHEN __upto >= ceil({share!r}D * __all) THEN bucket END)").alias(name) for name, share in shares.items()]
    return ranked.groupBy(*map(quote, keys)).agg(F.sum("n").alias("n"), *least)
