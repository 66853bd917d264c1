"""STR-6(b): R1 and R2 on a live stream from keyed state.

A group is a lane (a share of the users, by hash) and a time bucket: groups cost a few calls each whatever they hold, so there
are lanes and not users of them. Every row is kept in its bucket's list state, a chunk of rows as one Arrow value, and as a
marker in the next bucket if a rule can look back on it from there; a timer ends the bucket when the watermark passes it, which
is when no row of it can still come. Then its rows are in order whatever order they came in, the rules are evaluated once for
all users of the lane, and the state is dropped. So alerts are final, equal to the batch result for every cut into
micro-batches, also R2's, and come a bucket and the watermark's delay after the event. A busy user's rows lie in as many groups
as buckets; a group holds a bucket and a look-back of a lane.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txnwatch.config import EARTH_RADIUS_KM, TAG_GEO_JUMP, TAG_VELOCITY, RuleSet

#: Buckets are this many look-backs wide: wider ones make fewer markers, and later alerts.
LOOK_BACKS = 2
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Shares that the users are dealt into. Fixed: a stream that goes on after a restart finds its groups by it.
LANES = 32
_HELD = pa.schema([
    ("user_id", pa.string()), ("marker", pa.bool_()), ("sec", pa.int64()), ("micros", pa.int64()), ("transaction_id", pa.string()),
    ("kafka_partition", pa.int32()), ("kafka_offset", pa.int64()), ("latitude", pa.float64()), ("longitude", pa.float64())])
_ORDER = ["user_id", "micros", "transaction_id", "kafka_partition", "kafka_offset"]
HITS = (
    "user_id string, transaction_id string, kafka_partition int, kafka_offset bigint, event_micros bigint, rule_type string, "
    "txn_count bigint, prev_micros bigint, distance_km double, time_diff_minutes double"
)


def _packed(rows: pd.DataFrame) -> bytes:
    """A chunk of rows as one Arrow stream."""
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows[_HELD.names], schema=_HELD, preserve_index=False)
    with pa.ipc.new_stream(sink, _HELD) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(chunks: Iterator[tuple]) -> pd.DataFrame:
    """The rows of the chunks; whole numbers stay whole beside nulls."""
    tables = [pa.ipc.open_stream(c[0]).read_all() for c in chunks]
    return (pa.concat_tables(tables) if tables else _HELD.empty_table()).to_pandas(integer_object_nulls=True)


def _distance(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Great-circle distance in km of each position to the one before; NaN where either lacks one and for the first."""
    la, lo = np.radians(lat), np.radians(lon)
    h = np.sin(np.diff(la) / 2) ** 2 + np.cos(la[:-1]) * np.cos(la[1:]) * np.sin(np.diff(lo) / 2) ** 2
    return np.concatenate([np.full(min(1, len(la)), np.nan), 2 * EARTH_RADIUS_KM * np.arcsin(np.minimum(1.0, np.sqrt(h)))])


class BucketRules(StatefulProcessor):
    """Keeps the rows of a (lane, bucket) until the bucket is over, then yields its hits."""

    def __init__(self, rules: RuleSet, width: int):
        self.window = int(round(rules.r1.window_minutes * 60))
        self.threshold = rules.r1.threshold
        self.far, self.minutes = rules.r2.max_distance_km, float(rules.r2.max_interval_minutes)
        self.on = (rules.r1.enabled, rules.r2.enabled)
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "chunk binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            self.rows.appendList([(_packed(chunk),)])
            # A bucket of markers alone has nothing to say, but its state has to end, too.
            self.handle.registerTimer((int(key[1]) + 1) * self.width * 1000)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = _unpacked(self.rows.get())
        self.rows.clear()
        yield self.hits(held)

    def hits(self, held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(_ORDER, ignore_index=True)
        sec, micros = held.sec.to_numpy(np.int64), held.micros.to_numpy(np.int64)
        users = held.user_id.to_numpy(object)
        first = np.concatenate([np.ones(min(1, len(held)), bool), users[1:] != users[:-1]])
        # Seconds of one user after another on one scale, further apart than the window reaches.
        since = sec - sec.min() if len(held) else sec
        scale = (np.cumsum(first) - 1) * (int(since.max()) + self.window + 1 if len(held) else 1) + since
        count = np.searchsorted(scale, scale, "right") - np.searchsorted(scale, scale - self.window, "left")
        km = np.where(first, np.nan, _distance(held.latitude.to_numpy(float), held.longitude.to_numpy(float)))
        minutes = np.where(first, np.nan, np.diff(sec, prepend=sec[:1]) / 60.0)
        own = ~held.marker.to_numpy(bool)
        out = []
        for fires, tag in ((self.on[0] & (count > self.threshold), TAG_VELOCITY), (self.on[1] & (km > self.far) & (minutes < self.minutes), TAG_GEO_JUMP)):
            at = np.flatnonzero(own & fires)
            hit, r1 = held.iloc[at], tag == TAG_VELOCITY
            none = [None] * len(at)
            out.append(pd.DataFrame({
                "user_id": hit.user_id.to_list(), "transaction_id": hit.transaction_id.to_list(), "kafka_partition": hit.kafka_partition.to_list(),
                "kafka_offset": hit.kafka_offset.to_list(), "event_micros": micros[at].tolist(), "rule_type": [tag] * len(at),
                "txn_count": count[at].tolist() if r1 else none, "prev_micros": none if r1 else micros[at - 1].tolist(),
                "distance_km": none if r1 else km[at].tolist(), "time_diff_minutes": none if r1 else minutes[at].tolist(),
            }, dtype=object))
        return pd.concat(out, ignore_index=True)


def bucket_width(rules: RuleSet) -> tuple[int, int]:
    """(seconds the rules look back, seconds of a bucket)."""
    reach = max(int(round(rules.r1.window_minutes * 60)), math.ceil(rules.r2.max_interval_minutes * 60), 1)
    return reach, LOOK_BACKS * reach


def keyed_user_rules(txns: DataFrame, rules: RuleSet) -> DataFrame:
    """Hits of R1 and R2 (columns HITS; each rule's own evidence, the other's null) of a watermarked stream of transactions.

    The session must use the RocksDB state store (PROVIDER). Rows without user or time are never scored.
    """
    reach, width = bucket_width(rules)
    sec, bucket = "unix_seconds(`timestamp`)", f"CAST(floor(unix_seconds(`timestamp`) / {width}) AS BIGINT)"
    copies = f"CASE WHEN {sec} + {reach} >= ({bucket} + 1) * {width} THEN array(0, 1) ELSE array(0) END"
    rows = txns.where("user_id IS NOT NULL AND `timestamp` IS NOT NULL").selectExpr(
        "user_id", "`timestamp`", "transaction_id", "kafka_partition", "kafka_offset", "latitude", "longitude", f"{bucket} AS own_bucket", f"explode({copies}) AS copy")
    rows = rows.selectExpr(
        f"pmod(xxhash64(user_id), {LANES}) AS lane", "user_id", "own_bucket + copy AS bucket", "`timestamp`", "copy = 1 AS marker", f"{sec} AS sec", "unix_micros(`timestamp`) AS micros",
        "transaction_id", "kafka_partition", "kafka_offset", "latitude", "longitude")
    return rows.groupBy("lane", "bucket").transformWithStateInPandas(BucketRules(rules, width), HITS, "Append", "EventTime")
