"""RUL-6 at scale: distinct accounts per merchant in a trailing window from mergeable sketches.

Each (key, bucket of time) has one HyperLogLog sketch, built map-side and merged by the aggregation, so a busy merchant sends a
sketch a bucket and task and not its accounts; a bucket's sketch goes to every window that covers it, and a union answers. A
sketch has at most about 2**lg_k bytes. Its estimate has a relative standard error of 1.04 / sqrt(2**lg_k), 1.6 % by default;
up to some hundred accounts it is all but exact. The exact form is operators.trailing.trailing_distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions.time import epoch_seconds_sql, quote

LG_K = 12


def trailing_distinct_sketch(df: DataFrame, key: str, item: str, ts: str, bucket_seconds: int, buckets: int, out: str, lg_k: int = LG_K) -> DataFrame:
    """``key``, ``bucket_end`` (epoch seconds) and ``out``: about how many ``item`` values the key's rows have in the last
    ``buckets`` buckets up to that end, for each bucket in which the key has any row.

    Null items are not counted, null keys are a key of their own, rows without a time are left out. A bucket of null items
    alone still gets a row.
    """
    b = int(bucket_seconds)
    rows = df.selectExpr(f"{quote(key)} AS k", f"{quote(item)} AS i", f"CAST(floor({epoch_seconds_sql(df, ts)} / {b}) AS BIGINT) AS b").where("b IS NOT NULL")
    per = rows.groupBy("k", "b").agg(F.hll_sketch_agg("i", lg_k).alias("s"))
    spread = per.selectExpr("k", "s", f"inline(transform(sequence(0, {int(buckets) - 1}), d -> struct(b + d AS b, d = 0 AS own)))")
    merged = spread.groupBy("k", "b").agg(F.bool_or("own").alias("own"), F.hll_union_agg("s").alias("s")).where("own")
    return merged.select(F.col("k").alias(key), ((F.col("b") + 1) * b).alias("bucket_end"), F.hll_sketch_estimate("s").alias(out))
