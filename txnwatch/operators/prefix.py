"""Trailing counts by prefix sums over pre-aggregated seconds.

Rows are first counted by (key, second), combined before the shuffle, so a busy key brings a row a second and not its
transactions, and no payload. For a window ``[s - W, s]`` the count is ``P(s) - P(s - W - 1)``, P being the number of rows up
to a second. P is taken within blocks of ``block`` seconds: every second is in its block once as itself and once for each
window as a question at ``s - W - 1``, and a running sum answers both; the whole blocks between the two are added from the
blocks' totals, at most ``ceil((W + 1) / block)`` of them, summed over the key's blocks and met by one row a block in the
same window partition: no join, so nothing is broadcast, and no block is copied to the ones after it. A window partition
holds one block of seconds of one key, or a key's block totals, whatever the window's width and the key's share of the rows.
Several windows of one key share the exchange.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions.time import epoch_seconds_sql, quote
from txnwatch.operators.trailing import spread

#: Seconds of a block.
BLOCK = 3600


def counts_by_second(df: DataFrame, key: str, ts: str, windows: Mapping[str, int], block: int = BLOCK) -> DataFrame:
    """``key``, ``__sec`` and for each name in ``windows`` the number of rows of the key in that many seconds up to it, closed.

    One row for each second in which the key has any. Null keys are a key of their own; rows without a time are left out.
    """
    names, spans = list(windows), [int(w) for w in windows.values()]
    seconds = df.selectExpr(f"{quote(key)} AS k", f"{epoch_seconds_sql(df, ts)} AS s").where("s IS NOT NULL")
    seconds = seconds.groupBy("k", "s").agg(F.count("*").alias("n"))
    # Rows of the d blocks before a block, for each d that a window spans: floor or ceil of (W + 1) / block.
    spanned = sorted({d for w in spans for d in ((w + 1) // block, -(-(w + 1) // block)) if d})
    blocks = seconds.groupBy("k", F.expr(f"CAST(floor(s / {block}) AS BIGINT) AS b")).agg(F.sum("n").alias("n"))
    before = [f"coalesce(sum(n) OVER (PARTITION BY k ORDER BY b RANGE BETWEEN {d} PRECEDING AND 1 PRECEDING), 0L) AS d{d}" for d in spanned]
    blocks = blocks.selectExpr("k", "CAST(NULL AS BIGINT) AS s", "-2 AS w", "CAST(NULL AS BIGINT) AS t", "0L AS n", "b", *before)
    # Itself (w = -1) and the question of each window, both in the block that holds its second t; ahead of them the block's own row.
    events = ", ".join(["struct(-1 AS w, s AS t, n AS n)", *[f"struct({i} AS w, s - {w + 1} AS t, 0L AS n)" for i, w in enumerate(spans)]])
    asked = seconds.selectExpr("k", "s", f"inline(array({events}))").selectExpr(
        "*", f"CAST(floor(t / {block}) AS BIGINT) AS b", *[f"CAST(NULL AS BIGINT) AS d{d}" for d in spanned])
    running = "OVER (PARTITION BY k, b ORDER BY t NULLS FIRST RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    summed = spread(asked.unionByName(blocks), ["k", "b"], df).selectExpr("k", "s", "w", "b", f"sum(n) {running} AS upto", *[f"first(d{d}, true) {running} AS d{d}" for d in spanned])
    between = [
        "CASE b - CAST(floor((s - %d) / %d) AS BIGINT) %s ELSE 0L END" % (w + 1, block, " ".join(f"WHEN {d} THEN d{d}" for d in spanned))
        for w in spans
    ]
    answers = [f"CASE w WHEN -1 THEN upto + {x} WHEN {i} THEN -upto ELSE 0L END AS c{i}" for i, x in enumerate(between)]
    total = summed.where("w > -2").selectExpr("k", "s", *answers).groupBy("k", "s").agg(*[F.sum(f"c{i}").alias(name) for i, name in enumerate(names)])
    return total.withColumnsRenamed({"k": key, "s": "__sec"})


def with_counts(df: DataFrame, key: str, ts: str, windows: Mapping[str, int], where: str | None = None, block: int = BLOCK) -> DataFrame:
    """``df`` with the counts of its rows' windows; of the seconds that ``where`` (on the counts) keeps, if it is given.

    Only those seconds meet the rows, so a rule's payload is joined to few; Spark broadcasts them by the bytes it measures.
    Rows without a time have no counts and are left out.
    """
    counts = counts_by_second(df, key, ts, windows, block)
    if where:
        counts = counts.where(where)
    counts = counts.selectExpr(f"{quote(key)} AS __k", "__sec AS __s", *map(quote, windows))
    rows = df.selectExpr("*", f"{epoch_seconds_sql(df, ts)} AS __sec")
    met = rows.join(counts, F.expr(f"{quote(key)} <=> __k AND __sec = __s"))
    return met.selectExpr(*map(quote, df.columns), *map(quote, windows))
