"""Substring dedup by content-defined chunks: a gear rolling hash cuts, digests find chunks that occur again."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import blocks, buffers, constants, prefix_hash, range_hash, split_join

#: Bytes of a chunk: least, mean beyond the least, most.
LEAST, MEAN, MOST = 24, 32, 160
#: A run of repeated chunks is cut from this length on; shorter ones are phrases that recur by chance.
RUN = 100

#: A chunk's place is its start times this number, plus its size.
PLACE = 1 << 16
#: Bytes that the rolling hash sees.
_SPAN = 32
_GEAR = (constants(256, 21) >> np.uint64(32)).astype(np.uint32)


def cut_points(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, mean: int = MEAN, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the chunks of several documents, each cut as if it stood alone.

    The hash at a byte sums gear numbers of the last 32 bytes, shifted by their distance: six doubling steps give it for all
    bytes at once. A chunk ends where the top bits of the hash are zero, ``least`` bytes after its start or later, or after
    ``most`` bytes; so an insertion moves the cuts near it only.
    """
    n = len(offsets) - 1
    size = np.diff(offsets)
    shift = np.repeat(np.arange(n) * _SPAN, size) if n > 1 else 0
    padded = np.zeros(len(data) + n * _SPAN, np.uint32)  # a gap of zeros lets no document see the one before
    place = np.arange(len(data)) + shift
    padded[place] = _GEAR[data]
    h, step = padded, 1
    with np.errstate(over="ignore"):
        while step < _SPAN:
            moved = h.copy()
            moved[step:] += h[:-step] << np.uint32(step)
            h, step = moved, step * 2
    marks = np.flatnonzero(h[place] >> np.uint32(32 - max(1, int(mean).bit_length() - 1)) == 0) + 1
    ends = []
    mark_at = np.searchsorted(marks, offsets)
    marks = marks.tolist()
    for d, (s, e) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        k, last = int(mark_at[d]), len(marks)
        while s < e:
            while k < last and marks[k] < s + least:
                k += 1
            s = min(marks[k] if k < last else e, s + most, e)
            ends.append(s)
    ends = np.array(ends, np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return starts, ends


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id, place, a, b) of each chunk; place is its start and size, a and b are its 128-bit digest."""
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for i, j in blocks(offsets):
            raw, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            start, end = cut_points(raw, at)
            owner = np.searchsorted(at, start, "right") - 1
            rows = pa.array(owner + i)
            digest = [range_hash(prefix_hash(raw, salt), start, end, salt) ^ (end - start).astype(np.uint64) for salt in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(rows), batch.column("doc_id").take(rows), pa.array((start - at[owner]) * PLACE + end - start), *(pa.array(x.view(np.int64)) for x in digest)],
                ["key", "doc_id", "place", "a", "b"],
            )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a block's bytes of text: what is built from one and sent back is small, however long the texts."""
    for batch in batches:
        _, offsets = buffers(batch.column("text"))
        for i, j in blocks(offsets):
            yield batch.slice(i, j - i)


def _strip(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """Cuts the runs of repeated chunks of ``run`` bytes or more out of each text."""
    for batch in _pieces(batches):
        data, offsets = buffers(batch.column("text"))
        kept, removed, spans = [], [], []
        for k, again in enumerate(batch.column("again").to_pylist()):
            raw = data[offsets[k] : offsets[k + 1]]
            n, parts, last = 0, [], 0
            merged: list[list[int]] = []
            for s, size in (divmod(x, PLACE) for x in sorted(set(again or []))):
                if merged and merged[-1][1] == s:
                    merged[-1][1] += size
                else:
                    merged.append([s, s + size])
            merged = [x for x in merged if x[1] - x[0] >= run]
            for s, e in merged:
                parts.append(raw[last:s])
                last, n = e, n + e - s
            parts.append(raw[last:])
            kept.append(b"".join(p.tobytes() for p in parts))
            removed.append(n)
            spans.append(len(merged))
        names = [c for c in batch.schema.names if c not in ("text", "again")]
        arrays = [batch.column(c) for c in names]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
            [*names, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
        )


def strip_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256: a row for each row of ``docs``.

    Of equal chunks the first stays, in the order of doc_id (null last), text key and place; the others go where they make
    up a run of ``run`` bytes or more. Null text is the empty one. Rows with equal doc_id and text are one document. Of
    equal texts under several ids the first keeps what is new in it. Texts of one id, and those without, are told apart by a
    64-bit hash: it goes with every chunk.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("key"), F.col(text).alias("text"))
    chunks = rows.mapInArrow(_chunks, "key long, doc_id long, place long, a long, b long")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("key").alias("key"), F.col("place").alias("place"))
    # A chunk that only repeated rows share comes through here as well; below it equals its first.
    first = chunks.groupBy("a", "b").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").select("a", "b", "first")
    again = split_join(chunks, first, ["a", "b"]).where(~order.eqNullSafe(F.col("first")))
    again = again.groupBy("key", "doc_id").agg(F.collect_set("place").alias("again")).select(F.col("key").alias("_key"), F.col("doc_id").alias("_id"), "again")
    both = rows.join(again, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "again")
    out = both.mapInArrow(lambda it: _strip(it, run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return out.withColumnRenamed("doc_id", doc_id)
