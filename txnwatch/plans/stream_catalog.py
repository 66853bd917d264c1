"""Named queries that run as streams: the whole ``events`` table replayed, the sink's table returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.config import RuleSet
from txnwatch.functions.time import epoch_seconds
from txnwatch.operators import quantiles
from txnwatch.operators.windows import window_counts
from txnwatch.session import pin_utc
from txnwatch.sources.events import load_transactions
from txnwatch.sources.wire import to_envelope
from txnwatch.streaming import StreamJob, measured, read_table
from txnwatch.streaming.changes import GeoChangeLog
from txnwatch.streaming.keyed import PROVIDER, keyed_user_rules
from txnwatch.streaming.pairs import PAIR_COLUMNS, band_pairs
from txnwatch.streaming.replay import run_to_end, stream_folder, transaction_stream

BAND_SECONDS = 3600
BAND_KM = 1000


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return transaction_stream(spark, f"{sf_dir}/events.parquet")


def _wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def q_stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOIN-3: every two transactions of a user at most an hour and more than 1,000 km apart, by a stream-stream join."""
    pairs = band_pairs(_stream(spark, sf_dir), _stream(spark, sf_dir), BAND_SECONDS, BAND_KM)
    return _wall_clock(run_to_end(pairs, stream_folder(spark, "pairs")), "timestamp", "prev_ts").select(*PAIR_COLUMNS)


def _counts(key: str, duration: str, slide: str | None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """STR-1/3/4: the windows that the watermark has closed when the stream ends."""
        counts = window_counts(_stream(spark, sf_dir), key, duration, slide)
        return _wall_clock(run_to_end(counts, stream_folder(spark, "counts")), "window_start", "window_end")
    return run


def _user_rules(rules: RuleSet):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """STR-6(b): R1 and R2 from keyed state, for the buckets that the watermark has closed when the stream ends."""
        session = spark.newSession()  # with a state store of its own
        session.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
        hits = run_to_end(keyed_user_rules(_stream(session, sf_dir), rules), stream_folder(spark, "user-rules"), reader=spark)
        return hits.withColumn("distance_km", F.round("distance_km", 6))
    return run


CHANGE_BATCHES = 3
REPLAY_BATCHES = 4


def _change_log(rules: RuleSet):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """STR-2: the R2 change log when the table arrives in three batches that each hold rows from all of its time."""
        pin_utc(spark)
        tx = load_transactions(spark, sf_dir)
        changes = GeoChangeLog(stream_folder(spark, "changes"), rules)
        turn = F.col("kafka_offset") % CHANGE_BATCHES
        for b in range(CHANGE_BATCHES):
            changes.advance(tx.where(turn <= b), tx.where(turn == b), b)
        rows = changes.log(spark).withColumn("distance_km", F.round("distance_km", 6))
        return rows.select("batch_id", "op", "kafka_partition", "kafka_offset", "transaction_id", "prev_sec", "distance_km")
    return run


def _replayed(spark: SparkSession, sf_dir: str, rules: RuleSet) -> StreamJob:
    """The job after the whole table has gone through it as micro-batches, equal spans of event time in order."""
    pin_utc(spark)
    tx = load_transactions(spark, sf_dir)
    sec = epoch_seconds(tx, "timestamp")
    lo, hi = tx.agg(F.min(sec), F.max(sec)).first()
    job = StreamJob(stream_folder(spark, "job"), rules=rules)
    if lo is not None:
        step = (hi - lo) // REPLAY_BATCHES + 1
        for b in range(REPLAY_BATCHES):
            job.process_batch(to_envelope(tx.where((sec >= lo + b * step) & (sec < lo + (b + 1) * step))), b)
    return job


def _replayed_alerts(rules: RuleSet):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """SNK-1..4, SRC-5, JOIN-2: the alerts table that the live job's batches leave, each looking back into Bronze."""
        alerts = read_table(spark, _replayed(spark, sf_dir, rules).root, "alerts")
        return alerts.select("alert_id", "rule_type", "user_hash", "amount", "kafka_partition", "kafka_offset")
    return run


def _replayed_latency(rules: RuleSet):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """AGG-7 as measured: from a record's ingest stamp to its alert's stamp. The times are the machine's own, so the
        query states what must hold of them: none is negative, and each quantile of the merged sketches of the
        batches is within the sketch's error of the exact one."""
        root = _replayed(spark, sf_dir, rules).root
        late = measured.latency(read_table(spark, root, "alerts"), read_table(spark, root, "bronze"))
        shares = {"p50": 0.5, "p95": 0.95}
        sketch = quantiles.merged(quantiles.histogram(late, ["batch_id", "rule_type"], "micros"), ["rule_type"])
        got = quantiles.quantiles(sketch, ["rule_type"], shares)
        # The batches are few and so are their pairs of stamps: the exact order of the values is that of their counts.
        counts = late.groupBy("rule_type", F.col("micros").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        exact = quantiles.quantiles(counts, ["rule_type"], shares).select("rule_type", *[F.col(s).alias(f"exact_{s}") for s in shares])
        close = " AND ".join(f"{s} <= exact_{s} AND exact_{s} - {s} <= exact_{s} / 64" for s in shares)
        return got.join(exact, "rule_type").selectExpr("rule_type", "n", "p50 >= 0 AS measured", f"{close} AS within_error")
    return run


def queries(wide: RuleSet) -> dict:
    return {
        "stream_user_rules": _user_rules(wide),
        "r2_change_log": _change_log(wide),
        "replayed_alerts": _replayed_alerts(wide),
        "replayed_latency": _replayed_latency(wide),
        "stream_pairs": q_stream_pairs,
        "stream_tumbling_user_counts": _counts("user_id", "5 minutes", None),
        "stream_sliding_merchant_counts": _counts("merchant_id", "30 minutes", "10 minutes"),
    }
