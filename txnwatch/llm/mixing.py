"""Soft-membership mixing: a classifier fitted on the label table gives every document posteriors of the domains, and
distributed projected-gradient least squares fits nonnegative document rates whose expected domain token totals match
the targets.

Rates r between 0 and MOST_RATE minimise (s - t)' W (s - t) + NEAR * mean((r - 1)^2), where s_k = sum_d r_d n_d p_dk is a
domain's share of the input's words n, t_k its target, p the posteriors, W the inverse of the mean of p p' over the documents
whose rate is not at a bound, which makes all directions bend alike, and means are by words. All rates start at 1. A step
moves every rate against the gradient, clips it, and goes along that way to the least value; the gradient of a document is
its posteriors' product with one number a domain, so a step is two aggregates over all documents, and the rates follow from
the list of steps. A domain that REACH times all documents cannot fill has no part in the fit and is named.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.llm import hashed
from txnwatch.llm.common import cut, text_key

#: Domains of the label table, and the share of all expected words that each is to have.
TARGETS = {"good": 0.97, "low": 0.01, "toxic": 0.02}
#: Expected words of the mixture for each word of the input.
BUDGET = 1.1
#: Labelled rows that the classifier is fitted on, those with the least hash of their id.
SAMPLE = 4000
#: Miss of a domain, relative to its target, at which the rates are done.
TOLERANCE = 1e-6
#: Weight of the squared distance from rate 1 against the squared misses.
NEAR = 1e-8
#: The highest rate of a document.
MOST_RATE = 100.0
#: A domain is out of reach if its target is more than so many times the words that the documents have of it.
REACH = 8.0
#: The fit has stalled when so many steps together lower the largest miss by less than a thousandth of it.
STALL = 10
#: Share of the input's words that the mixture keeps at least, each counted once; where the targets ask for less, all rates
#: are moved towards 1 by one factor until it does.
LEAST_KEPT = 0.5


def label_domain() -> Column:
    """Domain of a row of ``labels``; null (no label) if neither column says."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")


def fit(docs: DataFrame, labels: DataFrame, domains: list[str], doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> np.ndarray:
    """Weights of the domain classifier, from at most ``sample`` labelled rows; without any, all posteriors are equal."""
    chosen = labels.select(F.col("doc_id").alias("_id"), label_domain().alias("domain")).where(F.col("domain").isin(domains)).dropDuplicates(["_id"])
    chosen = F.broadcast(chosen.orderBy(F.xxhash64("_id"), "_id").limit(sample))  # at most ``sample`` rows of two short columns
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(chosen, "_id").select("_id", "domain", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots, dense = hashed.pack(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("domain"), pa.array(slots, pa.binary()), pa.array(dense, pa.binary())], ["_id", "domain", "slots", "dense"])

    got = rows.mapInArrow(features, "_id long, domain string, slots binary, dense binary").dropDuplicates(["_id"]).limit(sample).collect()
    got.sort(key=lambda r: r["_id"])
    wanted = np.array([[float(r["domain"] == k) for k in domains] for r in got]).reshape(len(got), len(domains))
    return hashed.train([bytes(r["slots"]) for r in got], [bytes(r["dense"]) for r in got], wanted)


def posteriors(docs: DataFrame, weights: np.ndarray, domains: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, key, n_words and the posteriors p (in the order of ``domains``) of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # a fixed number of slots

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, p = [], []
            for _, _, block in hashed.feature_blocks(b.column("text")):
                n.append(block.n_words)
                p.append(hashed.scores(shared.value, block))
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            p = np.concatenate(p) if p else np.zeros((0, len(domains)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * len(domains)), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(n.astype(np.int64)), lists], ["doc_id", "key", "n_words", "p"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(score, "doc_id long, key binary, n_words long, p array<double>")


@dataclass(frozen=True)
class Step:
    """A step of all rates: against ``slope`` (a number a domain) by ``size``, clipped, and ``share`` of the way there."""

    slope: np.ndarray
    size: float
    share: float = 0.0

    def way(self, rates: np.ndarray, p: np.ndarray) -> np.ndarray:
        return np.clip(rates - self.size * (p @ self.slope + NEAR * (rates - 1)), 0, MOST_RATE) - rates


def rates(p: np.ndarray, steps: list[Step]) -> np.ndarray:
    """Rates of documents with posteriors ``p`` after the steps."""
    r = np.ones(len(p))
    for step in steps:
        r = r + step.share * step.way(r, p)
    return r


def _posteriors(b: pa.RecordBatch, k: int) -> np.ndarray:
    return b.column("p").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def _sums(soft: DataFrame, k: int, names: list[str], of: Callable[[np.ndarray, np.ndarray], list[np.ndarray]]) -> np.ndarray:
    """Sums over all rows of what ``of`` makes of a batch's words and posteriors, one for each of ``names``."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names))
        for b in batches:
            total += np.concatenate([np.ravel(x) for x in of(b.column("n_words").to_numpy(), _posteriors(b, k))])
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], names)

    row = soft.select("n_words", "p").mapInArrow(part, ", ".join(f"{x} double" for x in names)).agg(*[F.sum(x).alias(x) for x in names]).first()
    return np.array([x or 0.0 for x in row])


def _state(soft: DataFrame, steps: list[Step], k: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Words, the domains' totals, and the sums of n p p' of the documents whose rate is not at a bound."""

    def of(n: np.ndarray, p: np.ndarray) -> list[np.ndarray]:
        r = rates(p, steps)
        free = n * ((r > 0) & (r < MOST_RATE))
        return [n.sum(keepdims=True), (n * r) @ p, (p * free[:, None]).T @ p]

    got = _sums(soft, k, [f"s{i}" for i in range(1 + k + k * k)], of)
    return float(got[0]), got[1 : k + 1], got[k + 1 :].reshape(k, k)


def _along(soft: DataFrame, steps: list[Step], k: int) -> tuple[np.ndarray, float, float]:
    """For the last of ``steps``, by words: its way's domain totals, its squared length, and its product with r - 1."""

    def of(n: np.ndarray, p: np.ndarray) -> list[np.ndarray]:
        r = rates(p, steps[:-1])
        way = steps[-1].way(r, p)
        return [(n * way) @ p, [n @ way**2, (n * way) @ (r - 1)]]

    got = _sums(soft, k, [f"s{i}" for i in range(k + 2)], of)
    return got[:k], got[k], got[k + 1]


def fit_rates(soft: DataFrame, domains: list[str], targets: Mapping[str, float] = TARGETS, budget: float = BUDGET) -> tuple[list[Step], dict]:
    """(steps from rate 1, report) for the rows of ``soft``.

    It ends when every reachable domain is within TOLERANCE of its target, or when it has stalled; ``miss`` of the report
    says how far off each domain is, relative to its target, and ``unreachable`` names those left out.
    """
    k = len(domains)
    n, now, free = _state(soft, [], k)
    aim = np.array([targets[d] for d in domains]) * budget
    unit = np.maximum(aim, 1e-6 * budget)
    now = before = now / max(n, 1)
    reached = REACH * before >= aim
    steps: list[Step] = []
    seen = [(np.abs(now - aim) / unit)[reached].max(initial=0)]
    while n and seen[-1] > TOLERANCE and (len(seen) <= STALL or seen[-1] < 0.999 * min(seen[:-STALL])):
        weight = np.linalg.pinv(free / n * np.outer(reached, reached), rcond=1e-9, hermitian=True)
        step = Step(weight @ (now - aim), 1.0)
        total, length, off = (x / n for x in _along(soft, [*steps, step], k))
        bend = float(total @ weight @ total) + NEAR * length
        if not bend:
            break
        share = min(1.0, max(0.0, -(float((now - aim) @ weight @ total) + NEAR * off) / bend))
        steps.append(replace(step, share=share))
        _, now, free = _state(soft, steps, k)
        now = now / n
        seen.append((np.abs(now - aim) / unit)[reached].max(initial=0))
    report = {
        "words": n, "before": (before * n).tolist(), "after": (now * n).tolist(), "targets": (aim * n).tolist(), "miss": (np.abs(now - aim) / unit).tolist(),
        "unreachable": [d for d, r in zip(domains, reached, strict=True) if n and not r], "steps": len(steps),
    }
    return steps, report


def with_rates(soft: DataFrame, steps: list[Step], k: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rates(_posteriors(b, k), steps))], [*b.schema.names, "rate"])

    return soft.mapInArrow(add, "doc_id long, key binary, n_words long, p array<double>, rate double")


def mixed(
    docs: DataFrame, labels: DataFrame, targets: Mapping[str, float] = TARGETS, budget: float = BUDGET, doc_id: str = "doc_id", text: str = "text", least_kept: float = LEAST_KEPT
) -> DataFrame:
    """doc_id, key, n_words, a posterior p_<domain> for each domain, rate, copies, miss, unreachable: a row for each row of ``docs``.

    copies is the rate rounded up or down by a hash of id and text, so that its mean is the rate; 0 leaves a document out.
    Null or empty text has no words and the classifier's prior; repeated rows are scored and counted one by one; without
    labels all posteriors are equal; an empty table gives no rows. Whatever its columns, only doc_id (a number) and text of
    ``docs`` are read. miss and unreachable are the same on all rows: the largest miss of a reachable domain relative to its
    target, and the names of the others, comma-joined. A warning says where a miss is over TOLERANCE. Where rates would leave
    out more than 1 - ``least_kept`` of the words, all are moved towards 1 alike, and miss is what then remains.
    """
    domains = sorted(targets)
    soft = cut(posteriors(docs, fit(docs, labels, domains, doc_id, text), domains, doc_id, text))
    steps, report = fit_rates(soft, domains, targets, budget)
    out = with_rates(soft, steps, len(domains))
    kept = out.agg(F.sum(F.col("n_words") * F.least("rate", F.lit(1.0))).alias("n")).first()["n"] or 0
    misses = dict(zip(domains, report["miss"], strict=True))
    if kept < least_kept * report["words"]:
        # Words kept and totals are linear in the factor.
        hold = (1 - least_kept) / (1 - kept / report["words"])
        out = out.withColumn("rate", 1 + F.lit(hold) * (F.col("rate") - 1))
        now = {d: x + hold * (y - x) for d, x, y in zip(domains, report["before"], report["after"], strict=True)}
        misses = {d: abs(now[d] - t) / max(t, 1e-6 * budget * report["words"]) for d, t in zip(domains, report["targets"], strict=True)}
    miss = max((m for d, m in misses.items() if d not in report["unreachable"]), default=0.0)
    if miss > TOLERANCE:
        warnings.warn(f"no rates meet the targets: {misses} off, relative to each", stacklevel=2)
    u = F.pmod(F.xxhash64("key", "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    out = out.withColumn("copies", F.floor(F.col("rate") + u).cast("long"))
    shares = [F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)]
    return out.select(F.col("doc_id").alias(doc_id), "key", "n_words", *shares, "rate", "copies", F.lit(miss).alias("miss"), F.lit(",".join(report["unreachable"])).alias("unreachable"))
