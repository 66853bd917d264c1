"""Hard negatives by Fagin's threshold algorithm.

For every dimension a shard keeps its candidates sorted by component. An anchor reads each list from the end that its sign
favours (a dimension where it is 0 has no list), every candidate seen is scored at once by random access to its whole
vector, and the threshold, the anchor's product with the components last read, bounds the score of all unseen ones. A
window of scores is done once the threshold is strictly below its k-th score or below its floor; the anchor stops when all
its windows are done or the lists end. Positives are found the same way, with one window that is open on both sides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.llm.common import cut
from txnwatch.llm.vectors import best, exact, integer_vectors, matrix, meet, widest

#: Entries of each list that are read in the first round; each further round reads twice as many.
DEPTH = 4


class Lists:
    """A shard's candidates, and for each dimension their places and components by ascending component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.order = np.argsort(rows, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(rows.T, self.order, axis=1)

    def first(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[tuple[int | None, int | None]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(places, scores) of the first ``k`` allowed candidates of each window [low, high] of scores; None is open."""
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        unseen = np.ones(n, bool)
        held = [np.zeros(0, np.int64)] * len(windows)
        scores = [np.zeros(0, anchor.dtype)] * len(windows)
        done = [high is not None and low is not None and high < low for low, high in windows]
        read, step = 0, DEPTH
        while read < n and not all(done):
            stop = min(n, read + step) if len(up) + len(down) else n
            fresh = np.zeros(n, bool)
            if len(up) + len(down):
                fresh[self.order[up, n - stop : n - read].ravel()] = True
                fresh[self.order[down, read:stop].ravel()] = True
            else:
                fresh[:] = True  # no list: every score is 0
            fresh &= unseen
            unseen &= ~fresh
            at = np.flatnonzero(fresh & allowed)
            got = self.rows[at] @ anchor
            threshold = anchor[up] @ self.sorted[up, n - stop] + anchor[down] @ self.sorted[down, stop - 1]
            for w, (low, high) in enumerate(windows):
                if done[w]:
                    continue
                inside = np.ones(len(at), bool)
                if low is not None:
                    inside &= got >= low
                if high is not None:
                    inside &= got <= high
                places, values = np.concatenate([held[w], at[inside]]), np.concatenate([scores[w], got[inside]])
                keep = best(values, self.ids[places], k)
                held[w], scores[w] = places[keep], values[keep]
                done[w] = bool((len(keep) == k and threshold < scores[w][-1]) or (low is not None and threshold < low))
            read, step = stop, step * 2
        return list(zip(held, scores, strict=True))


def _lists(queries: pa.Table, candidates: pa.Table) -> tuple[np.ndarray, Lists]:
    width = widest(queries, candidates)
    q, c = exact(matrix(queries, width), matrix(candidates, width))
    return q, Lists(candidates.column("id").to_numpy(), candidates.column("label").to_numpy(), c)


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table([pa.array(x, pa.int64()) for x in columns], names)


def _positives(k: int):
    def find(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        q, lists = _lists(anchors, candidates)
        out: list[tuple] = []
        for own, label, anchor in zip(anchors.column("id").to_pylist(), anchors.column("label").to_pylist(), q, strict=True):
            ((at, scores),) = lists.first(anchor, (lists.labels == label) & (lists.ids != own), [(None, None)], k)
            out += zip([own] * len(at), map(int, lists.ids[at]), map(int, scores), strict=True)
        return _table(out, ["anchor_id", "positive_id", "positive_score"])

    return find


def _negatives(k: int, least: int):
    def find(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        q, lists = _lists(anchors, candidates)
        out: list[tuple] = []
        rows = zip(anchors.column("id").to_pylist(), anchors.column("label").to_pylist(), anchors.column("positives").to_pylist(), q, strict=True)
        for own, label, positives, anchor in rows:
            # least * p <= 100 * n <= 100 * p, in whole numbers
            windows = [(-(-least * p["positive_score"] // 100), p["positive_score"]) for p in positives]
            for p, (at, scores) in zip(positives, lists.first(anchor, lists.labels != label, windows, k), strict=True):
                n = len(at)
                out += zip([own] * n, [p["positive_id"]] * n, [p["positive_score"]] * n, map(int, lists.ids[at]), map(int, scores), strict=True)
        return _table(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return find


def mine(rows: DataFrame, label: Column | None = None, every: int = 100, positives: int = 5, negatives: int = 5, least: int = 80, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``, an anchor's positives its first ``positives`` other rows of its
    label, and the negatives of a positive the first ``negatives`` rows of other labels that score from ``least`` per cent of
    the positive's score to all of it. Scores are inner products of the vectors, floor(256 * x) each; higher ones come first,
    ties by smaller id. A positive with a score below 0 has no negatives. Rows with a null id, label or vector or a null or
    non-finite component take no part; repeated rows count once (of several rows of one id, the one with the least label and
    vector); shorter vectors are filled up with 0; an empty table gives no rows. Only id, label and vector are read, whatever
    other columns there are. A score beyond long is an error.
    """
    all_rows = integer_vectors(rows, vec_id, vector, F.col("label") if label is None else label)
    anchors = all_rows.where(F.col("id") % every == 0)
    found = meet(anchors, all_rows, _positives(positives), "anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = found.withColumn("place", place).where(F.col("place") <= positives)
    # At most ``positives`` for an anchor.
    chosen = chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    found = meet(cut(anchors.join(chosen, "id")), all_rows, _negatives(negatives, least), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
