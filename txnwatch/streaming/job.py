"""The streaming job: one read, Bronze + Silver + alerts per micro-batch.

Spark rejects row-based windows (R1, R2, R4) on a streaming frame, so the
rules run inside ``foreachBatch`` over the micro-batch plus a bounded
look-back into Bronze:

1. decode and parse once; mark rows older than the watermark (max event
   time of earlier batches minus the delay) as late; write Bronze into this
   batch's folder, which a replay replaces as a whole -- the batch statistics are observed during
   that write; rejects (rare) go to their own table;
2. derive Silver from the Bronze rows just written;
3. read Bronze back for the keys in the batch, pruned to the event dates
   and seconds ``[min - L, max + L]`` (L = longest rule look-back), excluding
   late rows, and score the rules there; candidates are rows in
   ``[min, max + L]`` -- the left margin completes their frames, the right one
   re-scores rows a late arrival pushed over a threshold;
4. project alerts with the batch stamp, drop those already written by
   earlier batches (left-anti on ``alert_id`` and the place in the broker) and
   write this batch's folder, once.

Counting rules (R1, R3, R4) are monotone, so the union of alerts over all
batches equals the batch result on the accepted rows.  R2 equals it for
in-order input; a late row slipping between two others can leave an extra
R2 alert behind, never a missing one.

Layout under ``root``: ``bronze``, ``silver``, ``alerts``, ``rejects`` (only
written when a batch has any), ``_batches`` (flat append log, one row per
batch: stamp, max event time so far, event range of its accepted rows),
``_checkpoints/<name>``.
Bronze and Silver are partitioned ``batch_id / event_date / late`` -- too-late
rows are kept but sit under ``late=true`` (``late_rows`` reads them) -- alerts
``batch_id / event_date``.  Batch-major layout lets a micro-batch read exactly
the batches whose event range meets its look-back window (explicit paths, from
the batch log), so its cost is bounded by the horizon, never by the age of the
stream; readers of whole tables still prune on ``event_date``.
"""

from __future__ import annotations

import datetime as _dt
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    LongType,
    StructField,
    StructType,
)
from pyspark.sql.utils import AnalysisException

from txnwatch.config import DEFAULT_WATERMARK, RuleSet
from txnwatch.functions.time import epoch_seconds
from txnwatch.operators.alerts import to_alerts
from txnwatch.operators.rules import apply_all_rules
from txnwatch.plans.medallion import bronze, silver
from txnwatch.schemas import ALERT, ALERT_COLUMNS, BRONZE, BRONZE_COLUMNS, SILVER
from txnwatch.sources.wire import parse_wire, split_valid, split_valid_condition

_LOG_SCHEMA = StructType([
    StructField("batch_id", LongType(), False),
    # ingest and alert stamps, microseconds since the epoch
    StructField("stamp", LongType(), False),
    StructField("alert_stamp", LongType(), False),
    # largest event second before this batch: the watermark base it was accepted by
    StructField("prior_max", LongType(), True),
    # largest event second seen up to and including this batch
    StructField("max_event_sec", LongType(), True),
    # event-second range of the batch's accepted rows (null when none)
    StructField("lo_sec", LongType(), True),
    StructField("hi_sec", LongType(), True),
])


#: Bytes of Bronze files to a partition of the rules' exchanges: each task then writes an alert file a rule and date, and a part
#: for each MB left thousands of small ones.
EXCHANGE_BYTES = 8 << 20

_DATE = StructField("event_date", DateType(), True)
_LATE = StructField("late", BooleanType(), True)
_BATCH = StructField("batch_id", LongType(), True)
# Ids of transactions may collide; an alert's row also names where its transaction came from.
_INGEST = [f for f in BRONZE.fields if f.name in ("kafka_partition", "kafka_offset")]
# Declared schemas of the job's tables, layout (partition) columns last.
TABLE_SCHEMAS = {
    "bronze": StructType(BRONZE.fields + [_BATCH, _DATE, _LATE]),
    "silver": StructType(SILVER.fields + [_BATCH, _DATE, _LATE]),
    "alerts": StructType(ALERT.fields + _INGEST + [_BATCH, _DATE]),
    "_batches": _LOG_SCHEMA,
}


def _run_all(tasks) -> None:
    """Run independent Spark actions from driver threads; re-raise the first failure."""
    if len(tasks) <= 1:
        for task in tasks:
            task()
        return
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        for future in [pool.submit(t) for t in tasks]:
            future.result()


def _utc_date(df: DataFrame):
    """Date of the event time in UTC, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(epoch_seconds(df, "timestamp") / 86400).cast("int"))


def _interval_seconds(text: str) -> int:
    number, unit = text.split()
    unit = unit.rstrip("s").lower()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return int(float(number) * scale)


@dataclass
class StreamJob:
    """Fan one parsed stream out to Bronze, Silver and replay-safe alerts."""

    root: str
    rules: RuleSet = field(default_factory=RuleSet)
    watermark: str = DEFAULT_WATERMARK
    ip_octets: int = 2
    name: str = "txns"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def table(self, spark: SparkSession, table: str) -> DataFrame:
        return read_table(spark, self.root, table)

    # -- per-batch log -------------------------------------------------------
    # One row per batch (stamps, watermark base, max event second so far, accepted
    # event range), appended to a flat table once the batch's other tables are
    # written.  A replay takes its stamps and its watermark base from its own row,
    # so it decides exactly as the first run did.  After a (re)start only the
    # entries that the latest batch or a later one can look back on are collected,
    # and the driver-side copy is pruned after every batch; nothing is dropped
    # from the table.
    _seen: dict = field(default=None, init=False, repr=False)

    def _relevance_floor(self, max_event_sec: int | None) -> int | None:
        """Entries whose accepted range ends before this cannot meet any future
        batch's look-back (future rows are at most ``delay`` behind the max)."""
        if max_event_sec is None:
            return None
        span = self.lookback_seconds()
        return max_event_sec - _interval_seconds(self.watermark) - 2 * span - 1

    def _load_log(self, spark: SparkSession) -> dict:
        if self._seen is None:
            self._seen = {}
            try:
                log = self.table(spark, "_batches")
            except AnalysisException:
                return self._seen
            top = log.agg(F.max_by("prior_max", "batch_id").alias("prior"),
                          F.max("batch_id").alias("b")).first()
            if top["b"] is None:
                return self._seen
            floor = self._relevance_floor(top["prior"])
            keep = F.lit(True) if floor is None else (
                (F.col("batch_id") >= F.lit(top["b"])) | (F.col("hi_sec") >= F.lit(floor)))
            self._seen = {r["batch_id"]: r for r in log.filter(keep).dropDuplicates(["batch_id"]).collect()}
        return self._seen

    def _prune_log(self) -> None:
        latest = max(self._seen)
        floor = self._relevance_floor(self._seen[latest]["prior_max"])
        if floor is None:
            return
        for b in [b for b, e in self._seen.items()
                  if b != latest and (e["hi_sec"] is None or e["hi_sec"] < floor)]:
            del self._seen[b]

    def _prior(self, spark: SparkSession, batch_id: int):
        """(this batch's log row if it was completed before, max event second before it)."""
        seen = self._load_log(spark)
        if batch_id in seen:
            return seen[batch_id], seen[batch_id]["prior_max"]
        if seen and batch_id < max(seen):  # an older batch: its row is no longer held here
            own = self.table(spark, "_batches").where(F.col("batch_id") == batch_id).first()
            if own is not None:
                self._hold_history(spark, own)
                return own, own["prior_max"]
        earlier = [e["max_event_sec"] for b, e in seen.items()
                   if b < batch_id and e["max_event_sec"] is not None]
        return None, (max(earlier) if earlier else None)

    def _hold_history(self, spark: SparkSession, own) -> None:
        """Collect again the entries that the replay of an older batch can look back on."""
        floor = self._relevance_floor(own["prior_max"])
        past = self.table(spark, "_batches").where(F.col("batch_id") <= own["batch_id"])
        if floor is not None:
            past = past.where((F.col("hi_sec") >= F.lit(floor)) | (F.col("batch_id") == own["batch_id"]))
        self._seen.update({r["batch_id"]: r for r in past.dropDuplicates(["batch_id"]).collect()})

    def _batches_meeting(self, first: int, last: int, exclude: int | None = None,
                         extend: int = 0) -> list[int]:
        """Earlier batches whose accepted range (its end pushed by ``extend``)
        meets ``[first, last]``; bounded by the look-back horizon, not by how
        long the stream has run."""
        return sorted(b for b, e in self._seen.items()
                      if (exclude is None or b < exclude) and e["lo_sec"] is not None
                      and e["lo_sec"] <= last and e["hi_sec"] + extend >= first)

    def _read_batches(self, spark: SparkSession, table: str, batch_ids: list[int]) -> DataFrame | None:
        """Just the listed ``batch_id`` partitions of a table (explicit paths,
        so listing cost does not grow with the number of batches)."""
        if not batch_ids:
            return None
        base = self.path(table)
        pattern = f"{base}/batch_id={{{','.join(str(b) for b in batch_ids)}}}"
        try:
            return (spark.read.schema(TABLE_SCHEMAS[table]).option("basePath", base)
                    .parquet(pattern))
        except AnalysisException:
            return None

    def lookback_seconds(self) -> int:
        r = self.rules
        spans = [0]
        if r.r1.enabled:
            spans.append(int(round(r.r1.window_minutes * 60)))
        if r.r2.enabled:
            spans.append(int(round(r.r2.max_interval_minutes * 60)) + 1)
        if r.r4.enabled:
            spans.append(int(round(r.r4.window_minutes * 60)))
        return max(spans)

    # -- the micro-batch -----------------------------------------------------
    def process_batch(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        done, prior_max = self._prior(spark, batch_id)
        # Microseconds since the epoch: no zone of driver or session takes part.
        stamp = done["stamp"] if done else time.time_ns() // 1000
        stamp_col = F.timestamp_micros(F.lit(stamp))
        delay = _interval_seconds(self.watermark)

        parsed = parse_wire(batch_df)
        ok = split_valid_condition()
        psec = F.when(ok, epoch_seconds(parsed, "timestamp"))
        on_time = ok & (F.lit(True) if prior_max is None else psec >= F.lit(prior_max - delay))
        # Batch statistics ride along with the Bronze write (no extra pass).
        obs = Observation(f"batch_{batch_id}")
        observed = parsed.observe(
            obs,
            F.count(F.lit(1)).alias("total"),
            F.count(F.when(ok, 1)).alias("n"),
            F.min(F.when(on_time, psec)).alias("lo"),
            F.max(F.when(on_time, psec)).alias("hi"),
            F.max(psec).alias("mx"),
        )
        valid = observed.filter(ok)
        late = (F.lit(prior_max - delay) > epoch_seconds(valid, "timestamp")
                if prior_max is not None else F.lit(False))
        layout = ("batch_id", "event_date", "late")
        rows = bronze(valid, stamp_col).select(
            *BRONZE_COLUMNS, F.lit(batch_id).cast("long").alias("batch_id"),
            _utc_date(valid).alias("event_date"), late.alias("late"))
        self._write(rows, "bronze", batch_id, list(layout))
        stats = obs.get
        # Silver, alerts and rejects depend only on what is already written, not
        # on each other: submit them as concurrent jobs.
        tasks = []
        if stats["total"] > stats["n"]:
            _, rejects = split_valid(parse_wire(batch_df, keep_raw=True))
            tasks.append(lambda: self._write(
                rejects.withColumn("batch_id", F.lit(batch_id).cast("long")), "rejects", batch_id, ["batch_id"]))
        if stats["n"]:
            # Silver derives from the Bronze rows just written (one stamp, one parse).
            written = self._read_batches(spark, "bronze", [batch_id])
            tasks.append(lambda: self._write(
                silver(written, self.rules.salt, self.ip_octets, keep=layout), "silver", batch_id, list(layout)))
        # The alert stamp is taken when the alerts are about to be scored.
        alert_stamp = done["alert_stamp"] if done else time.time_ns() // 1000
        if stats["n"] and stats["lo"] is not None and not self._published(spark, batch_id):
            tasks.append(lambda: self._alerts(spark, batch_id, stats["lo"], stats["hi"],
                                              F.timestamp_micros(F.lit(alert_stamp))))
        mx = stats["mx"]
        if prior_max is not None and (mx is None or prior_max > mx):
            mx = prior_max
        lo, hi = stats["lo"], stats["hi"]
        _run_all(tasks)
        if done is None:
            # The entry comes last: a batch that has one is complete.
            entry = spark.createDataFrame([(int(batch_id), stamp, alert_stamp, prior_max, mx, lo, hi)], _LOG_SCHEMA)
            entry.coalesce(1).write.mode("append").parquet(self.path("_batches"))
            self._seen[int(batch_id)] = entry.first()
        self._prune_log()

    def _alerts(self, spark, batch_id: int, lo: int, hi: int, stamp_col) -> None:
        # Everything below reads the Bronze partitions back (this batch's was
        # just written): shallow file-scan plans, and lineage cut at a durable
        # table, so a lost executor recomputes from Bronze, not the source.
        span = self.lookback_seconds()
        first, last = lo - span, hi + span
        d0 = _dt.datetime.fromtimestamp(first, _dt.timezone.utc).date()
        d1 = _dt.datetime.fromtimestamp(last, _dt.timezone.utc).date()
        # this batch (just written) plus the earlier ones reaching into the window
        sources = self._batches_meeting(first, last, exclude=batch_id) + [batch_id]
        hist = self._read_batches(spark, "bronze", sources)
        hist = hist.filter(F.col("event_date").between(F.lit(d0), F.lit(d1)) & ~F.col("late"))
        hist_sec = epoch_seconds(hist, "timestamp")
        hist = hist.filter(hist_sec.between(first, last))
        accepted = self._read_batches(spark, "bronze", [batch_id]).filter(~F.col("late"))
        users = accepted.select("user_id").distinct()
        merchants = accepted.select("merchant_id").distinct()
        by_user = hist.join(users, "user_id", "left_semi").select(*BRONZE_COLUMNS)
        by_merchant = hist.join(merchants, "merchant_id", "left_semi").select(*BRONZE_COLUMNS)
        r = self.rules
        if not (r.r1.enabled or r.r2.enabled or r.r3.enabled or r.r4.enabled):
            return
        hits = apply_all_rules(accepted.select(*BRONZE_COLUMNS), r, inputs={
            "R1": by_user, "R2": by_user, "R4": by_merchant}, part_bytes=EXCHANGE_BYTES)
        hit_sec = epoch_seconds(hits, "timestamp")
        hits = hits.filter(hit_sec.between(lo, hi + span))
        ingest = ["kafka_partition", "kafka_offset"]
        alerts = to_alerts(hits, r, alert_time=stamp_col, keep=tuple(ingest))
        alerts = alerts.withColumn("event_date", _utc_date(alerts))
        # alerts on these candidates can only come from batches whose own
        # candidate window [lo_b, hi_b + span] met this one
        earlier = self._read_batches(spark, "alerts",
                                     self._batches_meeting(lo, hi + span, exclude=batch_id,
                                                           extend=span))
        if earlier is not None:
            earlier = earlier.filter(F.col("event_date").between(F.lit(d0), F.lit(d1)))
            # transaction ids may collide: the same alert is the same key from the same place
            earlier = earlier.select(F.col("alert_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in ingest])
            same = F.col("alert_id") == F.col("_id")
            for c in ingest:
                same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
            alerts = alerts.join(earlier, same, "left_anti")
        self._write(alerts.select(*ALERT_COLUMNS, *ingest, F.lit(batch_id).cast("long").alias("batch_id"),
                                  "event_date"),
                    "alerts", batch_id, ["batch_id", "event_date"])

    def _published(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether this batch's alerts are written already: they are published once, so that a
        feed over their files never sees them again after a replay."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path(f"alerts/batch_id={batch_id}/_SUCCESS"))
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def _write(self, df: DataFrame, table: str, batch_id: int, parts: list[str]) -> None:
        """Replace the whole of this batch's folder in ``table``."""
        rest = [p for p in parts if p != "batch_id"]
        writer = df.drop("batch_id").write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*rest) if rest else writer).parquet(self.path(f"{table}/batch_id={batch_id}"))

    # -- wiring --------------------------------------------------------------
    def start(self, source: DataFrame, trigger: dict | None = None):
        """Start the query on an envelope stream ``(value, partition, offset)``.

        ``trigger`` is passed to ``DataStreamWriter.trigger`` (default
        ``processingTime='5 seconds'``; tests use ``availableNow=True``).
        """
        trig = trigger or {"processingTime": "5 seconds"}
        return (source.writeStream
                .foreachBatch(self.process_batch)
                .option("checkpointLocation", self.path(f"_checkpoints/{self.name}"))
                .trigger(**trig)
                .start())

    def run_available(self, source: DataFrame) -> None:
        """Process everything available now, then stop."""
        q = self.start(source, {"availableNow": True})
        q.awaitTermination()
        if q.exception():
            raise q.exception()


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A job table with its declared schema (partition values typed, not inferred).

    Raises ``AnalysisException`` when the table has not been written yet.
    """
    path = f"{root.rstrip('/')}/{table}"
    schema = TABLE_SCHEMAS.get(table)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def late_rows(spark: SparkSession, root: str) -> DataFrame:
    """STR-2: rows that arrived after the watermark (kept in Bronze, never scored)."""
    return read_table(spark, root, "bronze").filter(F.col("late"))


def alert_feed(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-8 / FLT-7: newly written alerts as a stream.

    A batch's alerts are published once and never rewritten, also when the batch is
    replayed, so a file stream over the table yields exactly the inserts.
    """
    reader = spark.readStream.schema(TABLE_SCHEMAS["alerts"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(f"{root.rstrip('/')}/alerts")
