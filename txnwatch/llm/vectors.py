"""Integer vectors dealt into cells: blocks of queries met with shards of candidates, and the merge of what each cell finds.

A cell holds at most about CELL components of either side, whatever the table's size, so a task's memory is bounded; the
number of cells grows with both sides. A row takes part if it has an id and a vector without null or non-finite components.
Rows are told apart by id: repeated rows count once, and of several rows of one id the one with the least (label, vector)
counts. A shorter vector has the components it lacks as 0; an empty one has none.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import cut

#: Components of a shard of candidates, and of a block of queries.
CELL = 1 << 18


def integer_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: Column | None = None, scale: int = 256) -> DataFrame:
    """id, label, v (floor of ``scale`` times each component) of the rows that take part; written to the checkpoint folder once.

    A component whose integer does not fit a long is an error.
    """
    label = F.lit(0) if label is None else label
    out = rows.select(F.col(f"`{vec_id}`").cast("long").alias("id"), label.cast("long").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    out = out.where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL AND forall(x, c -> c IS NOT NULL AND abs(c) < double('Infinity'))")
    whole = f"transform(x, c -> CASE WHEN abs({scale}D * c) < 9.2e18D THEN CAST(floor({scale}D * c) AS BIGINT) ELSE CAST(raise_error('a component beyond long') AS BIGINT) END)"
    out = out.select("id", F.struct("label", F.expr(whole).alias("v")).alias("row")).groupBy("id").agg(F.min("row").alias("row"))
    return cut(out.select("id", "row.label", "row.v"))


def parts(rows: DataFrame, cell: int = CELL) -> int:
    """How many parts of about ``cell`` components ``rows`` is dealt into, 1 at least."""
    n = rows.agg(F.sum(F.size("v") + F.lit(1)).alias("n")).first()["n"] or 0
    return max(1, -(-n // cell))


def meet(queries: DataFrame, candidates: DataFrame, find: Callable[[pa.Table, pa.Table], pa.Table], schema: str, cell: int = CELL) -> DataFrame:
    """``find(queries, candidates)`` of every block of queries with every shard of candidates.

    Both sides have columns id and v; a row is sent once for each part of the other side.
    """
    blocks, shards = parts(queries, cell), parts(candidates, cell)
    left = queries.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "*")
    right = candidates.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), "*")
    return left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(find, schema)


def widest(*tables: pa.Table) -> int:
    return max(int(pc.max(pc.list_value_length(t.column("v"))).as_py() or 0) for t in tables)


def matrix(table: pa.Table, width: int) -> np.ndarray:
    """Rows of the list column v as a matrix of ``width`` columns, lacking components 0."""
    size = pc.list_value_length(table.column("v")).to_numpy()
    out = np.zeros((table.num_rows, width), np.int64)
    out[np.arange(width) < size[:, None]] = pc.list_flatten(table.column("v")).to_numpy()
    return out


def exact(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in the narrowest number type in which any sum of products of their rows is exact.

    Doubles hold integers to 2**53, longs to 2**63; beyond that Python's integers do the sums, and a score that does not
    fit a long is an error where the result is built.
    """
    top = [max((abs(int(m.min())), abs(int(m.max())))) if m.size else 0 for m in (queries, candidates)]
    most = top[0] * top[1] * max(1, queries.shape[1])
    kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object
    return queries.astype(kind), candidates.astype(kind)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by higher score, then smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    near = np.arange(len(scores))
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return near[np.lexsort((ids[near], -scores[near]))][:k]
