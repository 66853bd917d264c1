"""Quality classifier from weak labels: expectation-maximisation estimates how accurate overlapping heuristic labellers
are, and the posteriors that follow train a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm import hashed
from txnwatch.llm.common import text_key

#: Labellers, each with a vote where it is competent and none elsewhere: the first eight know bad texts, the last two good ones.
LABELLERS = ("symbols", "capitals", "marks", "pipes", "repetition", "no_sentences", "tiny", "digits", "prose", "plain")
_BASE = 3
#: Accuracy that a labeller is believed to have before its votes are compared with the others'.
START = 0.98
#: Share of good documents, as believed of a text without votes; kept fixed, so that a lone vote isn't outvoted by it.
PRIOR = 0.5
#: Documents that the scorer is trained on, those with the least hash of their text.
SAMPLE = 4000
KEEP = 0.5


def votes(b: hashed.Block) -> np.ndarray:
    """Documents x labellers: 0 bad, 1 none, 2 good."""
    share = dict(zip(hashed.CLASSES, b.shares.T, strict=True))
    variety = b.n_distinct / np.maximum(b.n_words, 1)
    small = b.n_words < 20
    bad = (
        share["symbol"] > 0.04,
        share["upper"] > 0.35,
        share["mark"] > 0.03,
        share["pipe"] > 0.02,
        (variety < 0.3) & (b.n_distinct < 60) & ~small,
        (share["comma_or_stop"] < 0.002) & ~small,
        b.n_words < 3,
        share["digit"] > 0.2,
    )
    good = (
        (share["lower"] + share["wide"] > 0.6) & (share["comma_or_stop"] > 0.005) & ~small & ((variety > 0.4) | (b.n_distinct >= 60)) & (share["pipe"] + share["mark"] < 0.01),
        (share["symbol"] < 0.01) & (share["mark"] < 0.005) & (share["pipe"] < 0.005) & (share["upper"] < 0.1) & (share["comma_or_stop"] > 0.002) & ~bad[4],
    )
    return np.column_stack([*(np.where(x, 0, 1) for x in bad), *(np.where(x, 2, 1) for x in good)])


def _pattern(v: np.ndarray) -> np.ndarray:
    return v @ (_BASE ** np.arange(v.shape[1]))


def _unpack(pattern: np.ndarray, m: int = len(LABELLERS)) -> np.ndarray:
    return pattern[:, None] // (_BASE ** np.arange(m)) % _BASE


def expectation_maximisation(pattern: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of good for each pattern, accuracy of each labeller) from counts of vote patterns.

    A labeller that votes is right with its accuracy, whatever the class and the others say; no vote says nothing. The
    accuracies start at START, are smoothed by half as many votes of that quality as they have, and stay in 0.55 to 0.999.
    Rounds go on until no posterior moves by 1e-9, or the probability of votes and accuracies, which no round can lower,
    has stopped rising.
    """
    v = _unpack(pattern)
    for_good, for_bad = (v == 2).astype(float), (v == 0).astype(float)
    cast = count @ (for_good + for_bad)
    assumed = cast / 2 + 1
    accuracy, post, best = np.full(v.shape[1], START), np.zeros(len(v)), -np.inf
    while True:
        right, wrong = np.log(accuracy), np.log(1 - accuracy)
        good = for_good @ right + for_bad @ wrong + np.log(PRIOR)
        bad = for_good @ wrong + for_bad @ right + np.log(1 - PRIOR)
        now = 1 / (1 + np.exp(-np.clip(good - bad, -500, 500)))
        value = count @ np.logaddexp(good, bad) + assumed @ (START * right + (1 - START) * wrong)
        if np.abs(now - post).max(initial=0) < 1e-9 or value <= best:
            return now, accuracy
        post, best = now, value
        agreed = (count * post) @ for_good + (count * (1 - post)) @ for_bad
        accuracy = np.clip((agreed + START * assumed) / (cast + assumed), 0.55, 0.999)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of vote patterns in each batch."""
    for b in batches:
        got = [_pattern(votes(block)) for _, _, block in hashed.feature_blocks(b.column("text"))]
        pattern, n = np.unique(np.concatenate(got) if got else np.zeros(0, np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pattern.astype(np.int64)), pa.array(n.astype(np.int64))], ["pattern", "n"])


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scorer's weights, posterior of good by pattern, accuracies). Pattern counts cover all documents; no more than
    3 ** labellers rows come to the driver, and ``sample`` rows of slots for the scorer."""
    texts = docs.select(F.col(text).alias("text"))
    counts = texts.mapInArrow(_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    counts.sort(key=lambda r: r["pattern"])
    pattern = np.array([r["pattern"] for r in counts], np.int64)
    post, accuracy = expectation_maximisation(pattern, np.array([r["n"] for r in counts], float))
    by_pattern = np.full(_BASE ** len(LABELLERS), 0.5)
    by_pattern[pattern] = post

    keyed = docs.select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    chosen = F.broadcast(keyed.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(sample))  # at most ``sample`` keys

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots, dense = hashed.pack(b.column("text"))
            got = [_pattern(votes(block)) for _, _, block in hashed.feature_blocks(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(np.concatenate(got).astype(np.int64)), pa.array(slots, pa.binary()), pa.array(dense, pa.binary())], ["key", "pattern", "slots", "dense"])

    got = keyed.join(chosen, "key").select("key", "text").mapInArrow(features, "key binary, pattern long, slots binary, dense binary").dropDuplicates(["key"]).limit(sample).collect()
    got.sort(key=lambda r: bytes(r["key"]))
    good = by_pattern[np.array([r["pattern"] for r in got], np.int64)]
    weights = hashed.train([bytes(r["slots"]) for r in got], [bytes(r["dense"]) for r in got], np.column_stack([1 - good, good]).reshape(len(got), 2))
    return weights, by_pattern, accuracy


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: float = KEEP, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_words, votes, posterior, score, kept: a row for each row of ``docs``.

    votes: a digit for each labeller, 0 bad, 1 none, 2 good. score: the scorer's probability that the whole text is good.
    Null text is the empty one; it has no features and gets the scorer's bias; repeated rows get a row each; an empty table
    gives no rows.
    """
    weights, by_pattern, _ = fit(docs, text, sample)
    shared = docs.sparkSession.sparkContext.broadcast((weights, by_pattern))  # a fixed number of slots and patterns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, posterior = shared.value
        for b in batches:
            n, s, p, v = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)], []
            for _, _, block in hashed.feature_blocks(b.column("text")):
                vote = votes(block)
                n.append(block.n_words)
                s.append(hashed.scores(w, block)[:, 1])
                p.append(posterior[_pattern(vote)])
                v += ["".join(map(str, x)) for x in vote.tolist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.concatenate(n).astype(np.int64)), pa.array(v, pa.string()), pa.array(np.concatenate(p)), pa.array(np.concatenate(s))], ["doc_id", "n_words", "votes", "posterior", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = rows.mapInArrow(score, "doc_id long, n_words long, votes string, posterior double, score double")
    return out.withColumn("kept", F.col("score") >= keep).withColumnRenamed("doc_id", doc_id)
