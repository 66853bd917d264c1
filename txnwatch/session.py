"""Session construction and cluster-provided settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock for hour() and timestamp casts,
# AQE for runtime coalescing / skew handling / join re-planning.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MB = 1 << 20


def sizing_conf(input_bytes: int, total_cores: int, split_bytes: int = 256 * MB) -> dict:
    """Partition sizing for a run over ``input_bytes`` on ``total_cores`` cores.

    Scans read ``split_bytes`` splits; shuffles start with about one partition
    per split (at least 2 per core), so no shuffle partition
    has to hold more than a split's worth of rows and spills stay bounded.  AQE
    then coalesces small partitions towards half a split and splits skewed ones.
    """
    wanted = -(-int(input_bytes) // int(split_bytes))
    shuffle = max(wanted, 2 * int(total_cores))
    shuffle = -(-shuffle // int(total_cores)) * int(total_cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(split_bytes * 2),
    }


def build_session(master: str | None = None, app_name: str = "txnwatch",
                  shuffle_partitions: int | None = None, conf: dict | None = None,
                  input_bytes: int | None = None, total_cores: int | None = None) -> SparkSession:
    """Get or create a session with the core settings applied.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[N]``.  Given ``input_bytes`` and ``total_cores`` the partition
    sizing follows :func:`sizing_conf`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(CORE_CONF)
    if input_bytes and total_cores:
        settings.update(sizing_conf(input_bytes, total_cores))
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Rules read hours and whole seconds in UTC; make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins.  Only when it is unset (tests, local runs) is
    ``fallback`` installed, and it must then be given explicitly.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not fallback:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback folder was given")
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir() or fallback
