"""Exact top-k search by inner product with MaxScore.

A vector's dimensions are terms; a term's postings are the candidates whose component is not 0. A query's terms are ordered
by the most that each can add to a score. While the least of them together stay strictly below the k-th best score so far,
they are non-essential: a candidate in none of the other, essential postings cannot enter the result. Essential postings
are traversed, their sums say which candidates are still competitive, and only those are probed in the non-essential
terms, the strongest first. Each shard of candidates is searched on its own and the shards' first k are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.llm.vectors import best, exact, integer_vectors, matrix, meet, widest

#: Candidates that are traversed before the threshold is raised again; the first step is a sixteenth.
STEP = 2048


class Shard:
    """Postings of a shard's candidates: for each term the places (ascending) and values, and the least and largest value."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, step: int = STEP):
        self.ids, self.rows = ids, rows
        self.edges = np.unique([0, min(step // 16, len(ids)), *range(step, len(ids), step), len(ids)])
        self.places = [np.flatnonzero(column) for column in rows.T]
        self.values = [column[at] for column, at in zip(rows.T, self.places, strict=True)]
        self.cuts = [np.searchsorted(at, self.edges).tolist() for at in self.places]
        zero = rows.dtype.type(0) if rows.dtype != object else 0
        self.low = np.array([min(v.min(), zero) if len(v) else zero for v in self.values], rows.dtype)
        self.high = np.array([max(v.max(), zero) if len(v) else zero for v in self.values], rows.dtype)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the first ``k`` candidates but for the id ``own``, by higher score, then smaller id."""
        bound = np.maximum(query * self.low, query * self.high)  # at least 0: a candidate may lack the term
        order = sorted(range(len(query)), key=lambda t: (bound[t], t))
        upto = np.concatenate([[0], np.cumsum(bound[order])]) if len(order) else np.zeros(1)
        held, scores, theta = np.zeros(0, np.int64), np.zeros(0, query.dtype), None
        for e, (i, j) in enumerate(zip(self.edges[:-1], self.edges[1:], strict=True)):
            # The first ``free`` terms of the order are non-essential.
            free = -1 if theta is None else int(np.searchsorted(upto, theta, "left")) - 1
            total = np.zeros(j - i, query.dtype)
            met = np.zeros(j - i, bool)
            for t in order[max(free, 0) :]:
                a, b = self.cuts[t][e], self.cuts[t][e + 1]
                at = slice(None) if b - a == j - i else self.places[t][a:b] - i
                total[at] += query[t] * self.values[t][a:b]
                met[at] = True
            if free < 0:  # a score of 0 is still competitive: candidates without any term count, too
                met[:] = True
            at = np.flatnonzero(met)
            at = at[self.ids[i + at] != own]
            sums = total[at]
            for f in range(free - 1, -1, -1):
                alive = sums + upto[f + 1] >= theta
                at, sums = at[alive], sums[alive]
                if not len(at):
                    break
                sums = sums + query[order[f]] * self.rows[i + at, order[f]]
            held, scores = np.concatenate([held, i + at]), np.concatenate([scores, sums])
            first = best(scores, self.ids[held], k)
            held, scores = held[first], scores[first]
            theta = scores[-1] if len(scores) == k else None
        return held, scores


def _find(k: int):
    def find(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        width = widest(queries, candidates)
        q, c = exact(matrix(queries, width), matrix(candidates, width))
        shard = Shard(candidates.column("id").to_numpy(), c)
        found: list[tuple] = []
        for own, query in zip(queries.column("id").to_numpy(), q, strict=True):
            at, scores = shard.search(query, own, k)
            found += zip([int(own)] * len(at), map(int, shard.ids[at]), map(int, scores), strict=True)
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table([pa.array(x, pa.int64()) for x in columns], ["query_id", "vec_id", "score"])

    return find


def search(rows: DataFrame, every: int = 50, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores (all, if fewer) of each query among all other rows.

    Queries are the rows whose id is divisible by ``every``; a score is the inner product of the vectors, floor(256 * x)
    each; ties go to the smaller id. Rows with a null id, a null vector or a null or non-finite component take no part;
    repeated rows count once; shorter vectors are filled up with 0, an empty vector scores 0 with all; a lone query has no
    rows; an empty table gives none. Only the id and the vector are read, whatever other columns there are. A score beyond
    long is an error.
    """
    all_rows = integer_vectors(rows, vec_id, vector).select("id", "v")
    found = meet(all_rows.where(F.col("id") % every == 0), all_rows, _find(k), "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
