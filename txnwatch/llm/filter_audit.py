"""Interaction audit of a set of document filters: what each removes in every order, alone, and by Shapley value.

Four filters read a text alone, one asks whether a smaller id has the same text. For that one, counting Bloom sketches are
built by each task and merged: a text with a counter of 1 is the only one with its digest and cleared. The texts of the
possible repeats alone are shuffled, grouped whole, for the least id of each. All failures of a document make up a mask;
documents are counted by part and mask, and every order's figures are sums over the 32 counts of a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import sql_regex

FILTERS = "ABCDE"
#: Positions of a digest in the sketch, counters for each document, and the most counters there are: beyond, the sketch
#: fills up, so it clears fewer texts and more are compared, and the bitmap that is broadcast stays at 128 MB.
HASHES = 2
COUNTERS_EACH = 16
MOST_COUNTERS = 1 << 30
#: Counters of a segment, which one task merges.
SEGMENT = 1 << 20
#: Digests that a task gathers before it hands on their counts.
GATHER = 1 << 18

_WORD_GAP = r"[\x20\x09-\x0D]+"


def failures(text: str = "text") -> Column:
    """Bit mask of the filters A to D that a text fails, by FILTERS' order; ``text`` is a column without nulls."""
    words = f"filter(split({text}, {sql_regex(_WORD_GAP)}), w -> w <> '')"
    tests = [
        "size(w) < 200",
        "100 * size(array_distinct(w)) < 50 * size(w)",
        f"100L * octet_length(regexp_replace({text}, '[^A-Z]+', '')) > 2L * length({text})",
        f"{text} RLIKE {sql_regex('[#$%&*|]')}",
    ]
    mask = " + ".join(f"IF({t}, {1 << i}, 0)" for i, t in enumerate(tests))
    return F.expr(f"transform(array({words}), w -> {mask})[0]")


def _positions(h: np.ndarray, counters: int) -> np.ndarray:
    """HASHES x n positions of 64-bit digests in the sketch."""
    h = h.astype(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    return np.array([(low + np.uint64(k) * high) % np.uint64(counters) for k in range(HASHES)]).reshape(HASHES, -1)


def repeated_positions(digests: DataFrame, counters: int) -> DataFrame:
    """segment, bits: for each segment of the merged sketch, which counters are 2 or more. ``digests`` has a column h."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted() -> Iterator[pa.RecordBatch]:
            at, count = np.unique(_positions(np.concatenate(held), counters), return_counts=True)
            segment = (at // np.uint64(SEGMENT)).astype(np.int64)
            for s, i, j in zip(*(x.tolist() for x in _runs(segment)), strict=True):
                where = (at[i:j] % np.uint64(SEGMENT)).astype(np.uint32).tobytes()
                # Counters end at 2: all that is asked is whether there is a second.
                often = np.minimum(count[i:j], 2).astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([where], pa.binary()), pa.array([often], pa.binary())], ["segment", "at", "n"])

        for b in batches:
            held.append(b.column("h").to_numpy(zero_copy_only=False))
            n += b.num_rows
            if n >= GATHER:
                yield from counted()
                held, n = [], 0
        if n:
            yield from counted()

    def merge(rows: pa.Table) -> pa.Table:
        total = np.zeros(SEGMENT, np.uint8)
        for at, n in zip(rows.column("at").to_pylist(), rows.column("n").to_pylist(), strict=True):
            where = np.frombuffer(at, np.uint32)
            total[where] = np.minimum(total[where] + np.frombuffer(n, np.uint8), 2)
        return pa.table({"segment": rows.column("segment")[:1], "bits": pa.array([np.packbits(total >= 2).tobytes()], pa.binary())})

    return digests.select("h").mapInArrow(sketch, "segment long, at binary, n binary").groupBy("segment").applyInArrow(merge, "segment long, bits binary")


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, first, end) of the runs of equal values of a sorted array."""
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], first, np.append(first[1:], len(values))


def possible_repeat(docs: DataFrame, counters: int) -> Column:
    """Whether the digest h of a row may stand twice in ``docs``; false is certain."""
    bits = np.zeros(counters // 8, np.uint8)
    for row in repeated_positions(docs, counters).toLocalIterator():  # counters / 8 bytes in all
        bits[row["segment"] * SEGMENT // 8 : (row["segment"] + 1) * SEGMENT // 8] = np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def maybe(h: pa.Array) -> pa.Array:
        at = _positions(h.to_numpy(zero_copy_only=False), counters)
        return pa.array((shared.value[at >> np.uint64(3)] << (at & np.uint64(7)).astype(np.uint8) & 128 > 0).all(axis=0))

    return maybe("h")


def counters_for(n: int) -> int:
    """Counters of the sketch for n documents, in whole segments."""
    return min(MOST_COUNTERS, max(1, -(-n * COUNTERS_EACH // SEGMENT)) * SEGMENT)


def flagged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part, mask of every row of ``docs``.

    A null text is empty, a null part the empty string. Rows of one id that repeat fail nothing for each other, as neither
    id is smaller; a row without id is neither an original nor a repeat.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256))).withColumn("h", F.xxhash64("digest"))
    with_id = rows.where("doc_id IS NOT NULL")
    maybe = possible_repeat(with_id, counters_for(docs.count()))
    # Grouped by the whole text; copies are combined before the shuffle.
    least = with_id.select("doc_id", "text", "digest", "h").where(maybe).groupBy("text", "digest").agg(F.min("doc_id").alias("doc_id"))
    # That no two texts share a digest is checked, not taken on trust.
    least = least.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("texts"))
    least = least.select("digest", F.when(F.col("texts") == 1, F.col("least")).otherwise(F.raise_error(F.lit("two texts share a digest"))).alias("doc_id"), F.lit(True).alias("original"))
    narrow = rows.select("doc_id", "part", "digest", failures().alias("mask"), F.when(F.col("doc_id").isNotNull(), maybe).otherwise(False).alias("maybe"))
    # Joined by id as well as digest: a text with many copies is one row on the right and no hot key.
    narrow = narrow.join(least, ["doc_id", "digest"], "left")
    return narrow.select("doc_id", "part", (F.col("mask") + F.when(F.col("maybe") & F.col("original").isNull(), 16).otherwise(0)).alias("mask"))


def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents by mask, and how many of them are labelled so.

    A document is good (toxic) if any of its label rows has quality (toxic) 1; nulls and missing rows say nothing.
    """
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.expr("coalesce(quality = 1, false)")).alias("good"), F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic"))
    return flags.join(marks, "doc_id", "left").groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def interactions(counts: DataFrame) -> DataFrame:
    """The audit of each part from its mask counts: one row for each order of the filters and step."""
    # At most 32 masks a part.
    counts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))
    orders = ["".join(o) for o in permutations(FILTERS)]
    steps = F.expr("explode(array(" + ", ".join(f"'{o}'" for o in orders) + "))").alias("filter_order")
    rows = counts.select("part", "m", steps).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = f"CAST(shiftleft(1, instr('{FILTERS}', substr(filter_order, {{}}, 1)) - 1) AS INT)"
    before = f"aggregate(sequence(1, {len(FILTERS)}), 0, (a, i) -> a + IF(i < step, {bit.format('i')}, 0))"
    rows = rows.select("*", F.expr(bit.format("step")).alias("own"), F.expr(before).alias("before"))

    def total(condition: str, what: str = "x.n") -> Column:
        return F.expr(f"aggregate(m, 0L, (a, x) -> a + IF({condition}, {what}, 0L))")

    removed = "x.mask & own <> 0 AND x.mask & before = 0"
    return rows.select(
        "part", "filter_order", "step",
        total("x.mask & (before | own) = 0").alias("kept"),
        total(removed).alias("removed"),
        total("x.mask & own <> 0 AND x.mask & before <> 0").alias("redundant"),
        total("x.mask = own").alias("unique_fails"),
        total(removed, "x.good").alias("good_lost"),
        total(removed, "x.toxic").alias("toxic_lost"),
        # In all orders together, each failed filter is the first as often.
        total("x.mask & own <> 0", f"x.n * {len(orders)} div bit_count(x.mask)").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley for each part and order.

    Filters, by the conditions that fail: A under 200 words; B under half the words distinct; C over 2 % of the code points
    are A to Z; D holds one of #$%&*|; E has the text of a smaller id, anywhere in the table, removed or not. Null texts are
    empty and fail A; empty ones fail neither B nor C. An empty table gives no rows. See flagged and mask_counts for nulls,
    repeated rows and labels. Other columns, whatever their names, are not read.
    """
    return interactions(mask_counts(flagged(docs, doc_id, text, part), labels))
