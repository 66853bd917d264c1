"""Per-key trailing-time operators, exact and skew-proof.

The plain form, ``count(*) over (partition by key order by sec range between
W preceding and current row)``, sends a hot key (one merchant with a third
of all rows) to a single task, and Spark's sliding range frame re-aggregates
the whole frame for every row: O(rows x frame).

The bucketed form used by default is exact as well:

* time is cut into buckets as wide as the look-back (``b = floor(sec / W)``),
  so the frame ``[s - W, s]`` of a row in bucket ``b`` only touches buckets
  ``b - 1`` and ``b``;
* every row is emitted twice: as itself into ``(key, b)`` and as a marker into
  ``(key, b + 1)`` carrying just what the next bucket needs;
* all frames are running (unbounded preceding) or whole-partition frames,
  which Spark evaluates incrementally.

A hot key is thereby split into one window partition per bucket, the shuffle
carries each row once plus a narrow marker, and nothing ever enumerates pairs.

Expressions are written as SQL text (``selectExpr``): the plan is the same as
with Column objects, but building it costs one call per expression instead of
one per node, which matters for the per-micro-batch planning of the stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.functions.time import epoch_seconds_sql, quote

STRATEGIES = ("bucketed", "window")

_SEC, _BKT, _COPY, _T, _W = "__sec", "__bkt", "__copy", "__t", "__w"
_OWN = f"{_COPY} = 0"
_RUNNING = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_WHOLE = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


#: Bytes of input files whose rows an exchange puts into one partition, and those that it puts there rather than make more than
#: MOST_UNSORTED partitions: up to ``spark.shuffle.sort.bypassMergeThreshold`` (200), tasks write their rows to the exchange as they
#: come; above, each holds all that it writes in memory, sorted by partition, until it must spill.
SPREAD_BYTES = 1 << 20
SPREAD_BYTES_SORTED = 8 << 20
MOST_UNSORTED = 200


def _read_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, as the planner knows them without a job; 0 for sources that do not tell."""
    if df.isStreaming:
        return 0
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str((1 << 63) - 1)))
    return sum(n for n in sizes if n < unknown)


def spread(df: DataFrame, keys: Sequence[str], source: DataFrame | None = None, part_bytes: int | None = None) -> DataFrame:
    """``df`` exchanged by ``keys`` into a partition for each ``part_bytes`` (SPREAD_BYTES) that ``source`` (``df``) reads, and beyond
    MOST_UNSORTED of them for each SPREAD_BYTES_SORTED.

    Left to itself, adaptive execution merges shuffle partitions until there is about one for each core, or 64 MB of
    compressed ones: what a task sorts then grows with the input. Where that is no more than the cores, and for sources of
    unknown size (a micro-batch), ``df`` stays as it is and the operator above asks for its own exchange.
    """
    size = _read_bytes(source if source is not None else df)
    each = part_bytes or SPREAD_BYTES
    n = max(min(-(-size // each), MOST_UNSORTED), -(-size // max(each, SPREAD_BYTES_SORTED)))
    if n <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(n, *[F.col(quote(k)) for k in keys])


def _check(strategy: str) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")


def _twice(df: DataFrame, ts: str, width: int, keep: Sequence[str],
           extra: dict[str, str] | None = None) -> DataFrame:
    """Each row as copy 0 (itself, bucket b) and copy 1 (marker for bucket
    b + 1).  Marker copies carry only ``keep`` (other columns null) so the
    shuffle moves each row once plus a narrow marker.  ``extra`` SQL columns
    are computed on top, from the helpers ``__sec``, ``__copy``, ``__bkt``.
    """
    cols = [c for c in df.columns if c != _SEC]
    doubled = df.selectExpr(*map(quote, cols), f"{epoch_seconds_sql(df, ts)} AS {_SEC}",
                            f"explode(array(0, 1)) AS {_COPY}")
    out = [quote(c) if c in keep else f"CASE WHEN {_OWN} THEN {quote(c)} END AS {quote(c)}"
           for c in cols]
    out += [_SEC, _COPY, f"floor({_SEC} / {int(width)}) + {_COPY} AS {_BKT}"]
    out += [f"{expr} AS {name}" for name, expr in (extra or {}).items()]
    return doubled.selectExpr(*out)


def trailing_count(df: DataFrame, key: str, ts: str, window_seconds: int, out: str,
                   strategy: str = "bucketed", part_bytes: int | None = None) -> DataFrame:
    """Add ``out`` = number of rows with the same ``key`` whose whole-second
    time lies in ``[s - window_seconds, s]`` (the row itself and same-second
    peers included)."""
    _check(strategy)
    w = int(window_seconds)
    cols = df.columns
    k, o = quote(key), quote(out)
    if strategy == "window":
        return (df.selectExpr("*", f"{epoch_seconds_sql(df, ts)} AS {_SEC}")
                  .selectExpr(*map(quote, cols), f"count(1) OVER (PARTITION BY {k} ORDER BY {_SEC} "
                                                 f"RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) AS {o}"))
    # A marker leaves the frame of later rows at second sec + W + 1.
    scored = _twice(df, ts, max(w, 1), keep=[key], extra={
        _T: f"CASE WHEN {_OWN} THEN {_SEC} ELSE {_SEC} + {w + 1} END",
        _W: f"CASE WHEN {_OWN} THEN 1 ELSE -1 END",
    })
    spec = f"PARTITION BY {k}, {_BKT} ORDER BY {_T}"
    count = (f"CAST(sum({_W}) OVER ({spec} {_RUNNING}) + "
             f"sum(CASE WHEN {_OWN} THEN 0 ELSE 1 END) OVER ({spec} {_WHOLE}) AS BIGINT) AS {o}")
    return spread(scored, [key, _BKT], part_bytes=part_bytes).selectExpr("*", count).where(_OWN).selectExpr(*map(quote, cols), o)


def previous_within(df: DataFrame, key: str, ts: str, order: Sequence[str], carry: Sequence[str],
                    max_gap_seconds: int, prefix: str = "prev_",
                    strategy: str = "bucketed", part_bytes: int | None = None) -> DataFrame:
    """Add ``prefix + c`` for ``c`` in ``carry``: the value on the previous row of
    the same key, ordered by ``(ts, *order)``.

    The bucketed form guarantees the previous row whenever it is less than
    ``max_gap_seconds`` whole seconds earlier; beyond that the columns may be
    null, which callers filtering on a gap below the bound cannot observe.
    """
    _check(strategy)
    cols = df.columns
    ordering = ", ".join(quote(c) for c in [ts, *order])
    outs = [quote(prefix + c) for c in carry]
    if strategy == "window":
        spec = f"PARTITION BY {quote(key)} ORDER BY {ordering}"
        return df.selectExpr(*map(quote, cols), *[f"lag({quote(c)}) OVER ({spec}) AS {o}"
                                                  for c, o in zip(carry, outs)])
    twice = _twice(df, ts, max(int(max_gap_seconds), 1), keep=[key, ts, *order, *carry])
    spec = f"PARTITION BY {quote(key)}, {_BKT} ORDER BY {ordering}"
    lagged = spread(twice, [key, _BKT], part_bytes=part_bytes).selectExpr("*", *[f"lag({quote(c)}) OVER ({spec}) AS {o}"
                                     for c, o in zip(carry, outs)])
    return lagged.where(_OWN).selectExpr(*map(quote, cols), *outs)


def trailing_distinct(df: DataFrame, key: str, item: str, ts: str, window_seconds: int, out: str,
                      strategy: str = "bucketed") -> DataFrame:
    """Add ``out`` = number of distinct ``item`` values among rows of the same
    ``key`` in ``[s - window_seconds, s]`` (whole seconds, closed).

    Bucketed form: an occurrence ``o`` at second ``t`` is the first of its item
    inside the frame of every row at ``s`` in ``[max(t, p + W + 1), t + W]``,
    ``p`` being the item's previous occurrence at the key.  The distinct count
    at ``s`` is the number of such intervals covering ``s``: a running sum of
    +1 at each start and -1 after each end, so no set is ever built.  ``p``
    only matters when it is at most W seconds back, which ``previous_within``
    guarantees; same-second repeats get an empty interval.
    """
    _check(strategy)
    w = int(window_seconds)
    cols = df.columns
    k, o = quote(key), quote(out)
    if strategy == "window":
        return (df.selectExpr("*", f"{epoch_seconds_sql(df, ts)} AS {_SEC}")
                  .selectExpr(*map(quote, cols),
                              f"CAST(size(collect_set({quote(item)}) OVER (PARTITION BY {k} "
                              f"ORDER BY {_SEC} RANGE BETWEEN {w} PRECEDING AND CURRENT ROW)) "
                              f"AS BIGINT) AS {o}"))
    pair, prev = "__pair", "__p" + _SEC
    base = df.selectExpr("*", f"{epoch_seconds_sql(df, ts)} AS {_SEC}",
                         f"named_struct('k', {k}, 'i', {quote(item)}) AS {pair}")
    with_prev = previous_within(base, pair, _SEC, order=[], carry=[_SEC],
                                max_gap_seconds=w + 1, prefix="__p")
    start = f"CASE WHEN {prev} IS NULL THEN {_SEC} ELSE greatest({_SEC}, {prev} + {w + 1}) END"
    doubled = with_prev.selectExpr(*map(quote, cols), _SEC, f"{start} AS __start",
                                   f"explode(array(0, 1)) AS {_COPY}")
    twice = doubled.selectExpr(
        *[quote(c) if c == key else f"CASE WHEN {_OWN} THEN {quote(c)} END AS {quote(c)}"
          for c in cols],
        _SEC, "__start", _COPY, f"floor({_SEC} / {max(w, 1)}) + {_COPY} AS {_BKT}")
    live = f"(__start < {_SEC} + {w + 1})"

    def ev(t: str, weight: str, probe: bool) -> str:
        return f"named_struct('t', CAST({t} AS BIGINT), 'w', {weight}, 'probe', {str(probe).lower()})"

    # copy 0: probe at its own second (+1 there when its interval starts
    # immediately), else +1 later at the start.  copy 1 (next bucket): +1 at
    # the start, -1 one second after the end.
    own_events = (f"array({ev(_SEC, f'CASE WHEN {live} AND __start = {_SEC} THEN 1 ELSE 0 END', True)}, "
                  f"{ev('__start', f'CASE WHEN {live} AND __start > {_SEC} THEN 1 ELSE 0 END', False)})")
    marker_events = (f"array({ev('__start', f'CASE WHEN {live} THEN 1 ELSE 0 END', False)}, "
                     f"{ev(f'{_SEC} + {w + 1}', f'CASE WHEN {live} THEN -1 ELSE 0 END', False)})")
    events = (f"filter(CASE WHEN {_OWN} THEN {own_events} ELSE {marker_events} END, "
              f"e -> e.probe OR e.w != 0)")
    flat = twice.selectExpr("*", f"explode({events}) AS __e")
    counted = spread(flat, [key, _BKT]).selectExpr(
        "*", f"CAST(sum(__e.w) OVER (PARTITION BY {k}, {_BKT} ORDER BY __e.t {_RUNNING}) "
             f"AS BIGINT) AS {o}")
    return counted.where("__e.probe").selectExpr(*map(quote, cols), o)
