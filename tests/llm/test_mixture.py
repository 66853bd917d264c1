"""The mixture of op10 and of the pipeline's last stage: what it keeps, what it meets, and least squares by brute force."""

import numpy as np
import pytest

import corpus_pipeline
from txnwatch.llm import mixing, quality_rules
from txnwatch.llm.common import cut

DOMAINS = sorted(mixing.TARGETS)


def soft_rows(spark, sf, filtered):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    docs = cut(quality_rules.filter_rules(docs)) if filtered else docs
    return docs, labels, cut(mixing.posteriors(docs, mixing.fit(docs, labels, DOMAINS), DOMAINS))


def brute_force(n, p, aim, weight, rounds):
    """Least squares over rates in [0, MOST_RATE] by plain projected gradient with steps of 1, no line search."""
    w, r = n / n.sum(), np.ones(len(n))
    for _ in range(rounds):
        slope = weight @ ((w * r) @ p - aim)
        r = np.clip(r - (p @ slope + mixing.NEAR * (r - 1)), 0, mixing.MOST_RATE)
    d = (w * r) @ p - aim
    return d @ weight @ d + mixing.NEAR * (w @ (r - 1) ** 2), r


@pytest.mark.parametrize("sf,filtered", [("sf0.01", False), ("sf0.01", True), ("sf0.1", True)])
def test_the_mixture_meets_what_is_reachable_and_keeps_the_corpus(spark, sf, filtered):
    docs, labels, soft = soft_rows(spark, sf, filtered)
    steps, report = mixing.fit_rates(soft, DOMAINS)
    rows = soft.toPandas()
    n, p = rows.n_words.to_numpy(float), np.array(rows.p.tolist())
    r = mixing.rates(p, steps)
    assert report["unreachable"] == (["low"] if filtered else []) and report["steps"] < 60
    totals = (n * r) @ p / n.sum()
    for k, d in enumerate(DOMAINS):
        if d not in report["unreachable"]:
            assert totals[k] == pytest.approx(mixing.TARGETS[d] * mixing.BUDGET, rel=1e-3)
    assert (n * np.minimum(r, 1)).sum() > (0.9 if filtered else 0.75) * n.sum()
    assert r.max() <= mixing.MOST_RATE and r.min() >= 0
    # by brute force
    reached = np.array([d not in report["unreachable"] for d in DOMAINS])
    weight = np.linalg.pinv((p * n[:, None]).T @ p / n.sum() * np.outer(reached, reached), rcond=1e-9, hermitian=True)
    aim = np.array([mixing.TARGETS[d] * mixing.BUDGET for d in DOMAINS])
    value, best = brute_force(n, p, aim, weight, 1000)
    assert (totals - aim) @ weight @ (totals - aim) + mixing.NEAR * (n / n.sum()) @ (r - 1) ** 2 == pytest.approx(value, abs=1e-6)
    assert np.abs(best - r).max() < 0.01


def test_the_pipelines_last_stage_keeps_its_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = cut(quality_rules.filter_rules(docs))
    out = corpus_pipeline.mix(spark, docs, "/root/testdata/sf0.01").selectExpr("doc_id", "copies", "unreachable", "size(split(text, ' ')) AS n").toPandas()
    words = docs.selectExpr("sum(size(split(text, ' '))) AS n").first()["n"]
    assert out.n.sum() > 0.9 * words and (out.copies >= 1).all() and set(out.unreachable) == {"low"}


def test_domains_without_documents_are_named(spark):
    rows = [(i, f"word{i % 7} and more of the same kind {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    got = mixing.mixed(docs, labels).select("unreachable").distinct().collect()
    assert [r.unreachable for r in got] == ["low,toxic"]


def test_a_mixture_of_almost_nothing_is_held_at_its_least_and_says_what_it_misses(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} and more of the same kind {i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    with pytest.warns(UserWarning, match="targets"):
        got = mixing.mixed(docs, labels, targets={"good": 0.1, "low": 0.1, "toxic": 0.0}, budget=0.1).toPandas()
    n, r = got.n_words, got.rate
    assert (n * np.minimum(r, 1)).sum() == pytest.approx(mixing.LEAST_KEPT * n.sum()) and (r >= 0).all()
    off = max(abs((n * r * got[f"p_{d}"]).sum() / n.sum() - 0.01) / 0.01 for d in ("good", "low"))
    assert got.miss.nunique() == 1 and got.miss[0] >= off > 10
