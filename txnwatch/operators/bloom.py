"""JOIN-1 / FLT-9 for lists over the broadcast bound: a Bloom filter of the list decides which transactions are shuffled.

The filter is a table of blocks, one row of sixteen 64-bit words each, built by one aggregation with map-side combine and
joined to the transactions by broadcast on the block number: no transaction moves for it, whatever the skew of its key. It has
at most ``max_blocks`` rows (44 MB by default), however long the list; a fuller filter lets more rows through to the exact join
and changes no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions.time import quote

WORDS = 16
PROBES = 5
BITS_PER_KEY = 12
MAX_BLOCKS = 1 << 18

_BLOCK, _BITS, _HASH, _MAYBE = "__bloom_block", "__bloom_bits", "__bloom_hash", "__bloom_maybe"


def _block(key: str, blocks: int) -> str:
    return f"pmod(xxhash64({key}), {int(blocks)}L)"


def _place(hashed: str, probe: int) -> str:
    """The ``probe``-th bit position in a block, ten bits of a second hash of the key."""
    return f"CAST(shiftright({hashed}, {10 * probe}) & {64 * WORDS - 1} AS INT)"


def bloom_blocks(keys: DataFrame, key: str, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """(the filter of the distinct ``keys``, the number of blocks that it is spread over).

    One job estimates the number of keys. A block without a key has no row.
    """
    count = keys.agg(F.approx_count_distinct(key)).first()[0]
    blocks = min(max(-(-count * BITS_PER_KEY // (64 * WORDS)), 1), max_blocks)
    hashed = keys.selectExpr(f"{_block(quote(key), blocks)} AS {_BLOCK}", f"xxhash64({quote(key)}, 1L) AS h")
    bits = hashed.selectExpr(_BLOCK, f"explode(array({', '.join(_place('h', i) for i in range(PROBES))})) AS p")
    words = [f"coalesce(bit_or(CASE WHEN p div 64 = {w} THEN shiftleft(1L, p % 64) END), 0L)" for w in range(WORDS)]
    return bits.groupBy(_BLOCK).agg(F.expr(f"array({', '.join(words)})").alias(_BITS)), blocks


def _marked(df: DataFrame, key: str, filtered: DataFrame, blocks: int) -> DataFrame:
    """``df`` with ``__bloom_maybe``: false only if the list doesn't hold the key."""
    probed = df.withColumns({_BLOCK: F.expr(f"CASE WHEN {quote(key)} IS NOT NULL THEN {_block(quote(key), blocks)} END"), _HASH: F.expr(f"xxhash64({quote(key)}, 1L)")})
    found = probed.join(F.broadcast(filtered), _BLOCK, "left")
    tests = [f"shiftright({_BITS}[{p} div 64], {p} % 64) & 1L = 1L" for p in (_place(_HASH, i) for i in range(PROBES))]
    return found.withColumn(_MAYBE, F.expr(f"coalesce({' AND '.join(tests)}, false)")).drop(_BLOCK, _BITS, _HASH)


def probable_hits(txns: DataFrame, blacklist: DataFrame, key: str, list_key: str | None = None, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """The rows of ``txns`` that the filter can't clear: every listed one and a few more."""
    listed = _listed(txns, blacklist, key, list_key)
    return _marked(txns, key, *bloom_blocks(listed, key, max_blocks)).where(_MAYBE).drop(_MAYBE)


def _listed(txns: DataFrame, blacklist: DataFrame, key: str, list_key: str | None) -> DataFrame:
    listed = blacklist.select(F.col(quote(list_key or key)).alias(key)).where(f"{quote(key)} IS NOT NULL")
    if listed.schema[key].dataType != txns.schema[key].dataType:
        raise TypeError("the list's key and the transactions' key must have one type: equal values of two types hash apart")
    return listed


def screen_large(txns: DataFrame, blacklist: DataFrame, key: str, keep: str = "hits", list_key: str | None = None,
                 max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """As ``screening.screen``, for a list too large to broadcast: only the filter's probable hits meet the list in a shuffle.

    ``keep='pass'`` reads the transactions twice: cleared rows go out as they are, the others through the anti join. A null
    key is never a hit, repeated list entries are one, an empty list hits nothing. A listed key that holds a large share of
    all rows is left to AQE, which splits the transactions' side of semi and anti joins.
    """
    if keep not in ("hits", "pass"):
        raise ValueError("keep must be 'hits' or 'pass'")
    listed = _listed(txns, blacklist, key, list_key)
    marked = _marked(txns, key, *bloom_blocks(listed, key, max_blocks))
    cols = [quote(c) for c in txns.columns]
    probable = marked.where(_MAYBE).select(*cols)
    exact = listed.distinct().hint("merge")
    if keep == "hits":
        return probable.join(exact, key, "left_semi").select(*cols)
    cleared = marked.where(f"NOT {_MAYBE}").select(*cols)
    return cleared.unionByName(probable.join(exact, key, "left_anti").select(*cols))
