"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each batch query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected).  Every query runs once untimed and once timed
on the same tables, so ``queries`` is steady-state latency (warm JVM, as on a
long-running cluster); the untimed first runs are summed in ``cold_total``.  ``stream_job`` pushes the events table
through the streaming fan-out job (Bronze + Silver + alerts) as 4 micro-batches
(also once untimed into a separate folder, like the batch queries); its
throughput is reported as ``stream_rows_per_sec``.
"""

from __future__ import annotations

import glob
import json
import os
import re
import shutil
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark.sql import functions as F  # noqa: E402

from txnwatch.plans import catalog  # noqa: E402
from txnwatch.session import build_session, checkpoint_dir  # noqa: E402

HEADLINE = [
    "all_rules", "all_rules_wide", "alerts", "r1_velocity_60m", "r2_geo_jump_60m",
    "r3_night_large_1000", "r4_merchant_velocity_30m", "r4_distinct_users_30m",
    "parse_flatten", "silver_projection", "sliding_user_counts", "interval_pairs",
    "alerts_by_rule", "latest_alerts", "bronze_silver_reconcile",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _stream(spark, sf_dir: str, scratch: str, batches: int = 4) -> tuple[float, int]:
    from txnwatch.sources.events import load_transactions
    from txnwatch.sources.streams import envelope_file_stream
    from txnwatch.sources.wire import to_envelope
    from txnwatch.streaming import StreamJob

    env = to_envelope(load_transactions(spark, sf_dir))
    n = env.count()
    parts = f"{scratch}/stream_parts"
    (env.withColumn("part", (F.col("offset") * batches / F.lit(max(n, 1))).cast("int"))
        .repartition("part").sortWithinPartitions("offset")
        .write.partitionBy("part").json(parts))
    # one file per micro-batch, oldest first in event order (the file source
    # orders by modification time)
    src = f"{scratch}/stream_in"
    os.makedirs(src)
    for i in range(batches):
        for k, f in enumerate(sorted(glob.glob(f"{parts}/part={i}/*.json"))):
            target = f"{src}/{i:04d}-{k:04d}.json"
            shutil.copy(f, target)
            os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = envelope_file_stream(spark, src, max_files_per_trigger=1)
    job = StreamJob(f"{scratch}/stream_out", rules=catalog.WIDE)
    t0 = time.time()
    job.run_available(stream)
    return time.time() - t0, n


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app_name="txnwatch-bench", shuffle_partitions=cpus,
                          conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="run-bench-", dir="/tmp")
    checkpoint_dir(spark, fallback=f"{scratch}/checkpoints")

    qs = catalog.queries()
    times: dict[str, float] = {}
    cold = 0.0
    for name in HEADLINE:
        t0 = time.time()
        _run(qs[name](spark, sf_dir))
        cold += time.time() - t0
        t0 = time.time()
        _run(qs[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
    cold_stream, _ = _stream(spark, sf_dir, f"{scratch}/cold")
    cold += cold_stream
    stream_secs, rows = _stream(spark, sf_dir, f"{scratch}/warm")
    times["stream_job"] = round(stream_secs, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cold_total": round(cold, 3),
        "stream_rows": rows,
        "stream_rows_per_sec": round(rows / stream_secs, 1) if stream_secs else None,
        "cpus": cpus,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
