"""Helpers shared by the training-data operators: keys, hot-key joins, Arrow buffers, checkpoints."""

from __future__ import annotations

import functools
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the vectorised kernels take at a time; a longer document is one block.
BLOCK_BYTES = 1 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_key(text: Column) -> Column:
    """16-byte content key; a null text has the key of the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join whose two sides always get an exchange of their own.

    An aggregate that is already partitioned by the join keys feeds a join without an exchange, and then
    adaptive execution cannot split a hot key.  The extra key, a function of the others, asks for one.
    """
    z = F.pmod(F.xxhash64(*on), F.lit(2))
    return left.withColumn("_z", z).join(right.withColumn("_z", z), [*on, "_z"], how).drop("_z")


#: Bytes up to which small_side broadcasts.
BROADCAST_BYTES = 64 << 20


def small_side(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if all its values take at most BROADCAST_BYTES, measured in full; beyond that, as it is.

    For sides that are cheap to compute (a test set's terms, a checkpointed table), as they are computed once more.
    """
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))) + F.lit(16)).alias("n")).first()["n"] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def where_computed(df: DataFrame, condition: Column | str) -> DataFrame:
    """``where`` on columns that are dear to compute, after they are computed.

    The optimizer moves a plain filter below the projections and copies their expressions into it, loops included; a
    condition on a non-deterministic column stays where it is. The number only serves that and decides nothing.
    """
    df = df.withColumn("_n", F.monotonically_increasing_id())
    return df.where((F.expr(condition) if isinstance(condition, str) else condition) & (F.col("_n") >= 0)).drop("_n")


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names. In local mode alone it may be unset: a scratch folder stands in."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="run-checkpoint-"))
    return spark.conf.get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint below checkpoint_folder.

    The garbage collection afterwards lets Spark's cleaner drop the shuffle files of what was cut off.
    """
    checkpoint_folder(df.sparkSession)
    out = df.checkpoint()
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage with a Parquet table below checkpoint_folder; it is smaller than a checkpoint's rows.

    The writing plan is not held afterwards, so Spark's cleaner can drop its shuffle files as soon as the driver collects.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary Arrow array and its n + 1 offsets; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    if offsets is None or len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES):
    """Ranges [i, j) of documents with about ``size`` bytes each, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX_A
        x = (x ^ (x >> np.uint64(27))) * _MIX_B
        return x ^ (x >> np.uint64(31))


def constants(n: int, salt: int = 0) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt * 1_000_003)) * _GOLD) | np.uint64(1)


@functools.lru_cache(maxsize=4)
def _powers(n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(constants(1, 77 + salt)[0])
    with np.errstate(over="ignore"):
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n + 1, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of a fixed odd base and of its inverse, modulo 2**64 (sizes rounded up so that they are reused)."""
    size = max(1 << 16, 1 << int(n).bit_length())
    if size <= 4 * BLOCK_BYTES:
        return _powers(size, salt)
    return _powers.__wrapped__(size, salt)


def prefix_hash(data: np.ndarray, salt: int = 0) -> np.ndarray:
    """Running sums for range_hash: n + 1 values."""
    up, _ = powers(len(data), salt)
    out = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(constants(256, 5 + salt)[data] * up[: len(data)], out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of data[start:end] for each pair; equal bytes have equal hashes wherever they stand."""
    _, down = powers(len(sums) - 1, salt)
    with np.errstate(over="ignore"):
        return mix((sums[end] - sums[start]) * down[start])


#: ASCII letters lower-cased, digits and non-ASCII bytes as they are, all else 0.
WORD_BYTES = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 0 for c in range(256)], np.uint8)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of several documents, and the n + 1 offsets of each document's words.

    A word is a run of ASCII letters (case ignored), digits and non-ASCII characters; none crosses documents.
    """
    low = WORD_BYTES[data]
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = low > 0
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(low))]
    first[edge] = inside[1:-1][edge]
    last[edge - 1] = inside[1:-1][edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return range_hash(prefix_hash(low), start, end), np.searchsorted(start, offsets)


def sql_regex(pattern: str) -> str:
    """A regular expression as a SQL string literal."""
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
