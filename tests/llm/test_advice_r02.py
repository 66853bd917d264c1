"""One test for each place where an operator did less than its whole job."""

import warnings

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from txnwatch.llm import decontamination, hashed, mixing, quality_rules, queries

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def mixture(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    return mixing.mixed(spark.read.parquet(f"{SF}/documents.parquet"), labels).toPandas()


def test_rates_meet_each_target_relative_to_it(mixture):
    words = mixture.n_words.sum()
    assert (mixture.rate >= 0).all() and mixture.miss.max() <= mixing.TOLERANCE
    for d, share in mixing.TARGETS.items():
        assert (mixture.n_words * mixture.rate * mixture[f"p_{d}"]).sum() / words == pytest.approx(share * mixing.BUDGET, rel=1e-5)


def test_rates_meet_targets_of_domains_that_overlap(spark):
    rng = np.random.default_rng(6)
    toxic = np.where(rng.random(3000) < 0.33, rng.beta(2, 3, 3000), rng.beta(1, 9, 3000))
    low = (1 - toxic) * rng.beta(1, 12, 3000)
    rows = [(int(n), [float(1 - t - u), float(u), float(t)]) for n, t, u in zip(rng.integers(1, 400, 3000), toxic, low, strict=True)]
    _, report = mixing.fit_rates(spark.createDataFrame(rows, "n_words long, p array<double>"), ["good", "low", "toxic"])
    assert max(report["miss"]) <= mixing.TOLERANCE and report["steps"] < 60


def test_targets_that_no_rates_meet_are_reported(spark):
    soft = spark.createDataFrame([(10, [0.5, 0.3, 0.2])] * 20 + [(30, [0.4, 0.3, 0.3])] * 20, "n_words long, p array<double>")
    steps, report = mixing.fit_rates(soft, ["good", "low", "toxic"])
    got = mixing.rates(np.array([r.p for r in soft.collect()]), steps)
    assert (got >= 0).all() and np.isfinite(got).all() and max(report["miss"]) > 0.5
    docs = spark.createDataFrame([(1, "some words here"), (2, "and more")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        miss = {r.miss for r in mixing.mixed(docs, none).collect()}
    assert len(miss) == 1 and miss.pop() > 0.5 and any("targets" in str(w.message) for w in said)


def test_classifier_finds_held_out_toxic_documents():
    """Trained on 3,000 labelled documents of sf0.1, held out the other 980."""
    rows = duckdb.sql(f"""SELECT DISTINCT ON (doc_id) doc_id, text, quality, toxic FROM '{SF}/documents.parquet' JOIN '{SF}/labels.parquet' USING (doc_id) ORDER BY hash(doc_id), doc_id""").fetchall()
    slots, dense = hashed.pack(pa.array([r[1] for r in rows]))
    kind = np.array([2 if r[3] == 1 else 1 if r[2] == 0 else 0 for r in rows])
    weights = hashed.train(slots[:3000], dense[:3000], np.eye(3)[kind[:3000]])
    p = np.concatenate([hashed.scores(weights, b) for _, _, b in hashed.feature_blocks(pa.array([r[1] for r in rows[3000:]]))])
    toxic, found = kind[3000:] == 2, p.argmax(axis=1) == 2
    assert toxic.sum() > 80 and (found & toxic).sum() >= 0.6 * toxic.sum()
    assert (found & ~toxic).sum() <= 0.01 * (~toxic).sum()


def test_minimum_is_reached():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(40, 12)) * np.logspace(0, 1, 12)
    b = rng.normal(size=40)
    x, done = hashed.minimise(lambda x: (float((a @ x - b) @ (a @ x - b)) / 2, a.T @ (a @ x - b)), np.zeros(12), 1e-5)
    assert done and x == pytest.approx(np.linalg.lstsq(a, b, rcond=None)[0], rel=1e-4, abs=1e-6)


def test_near_passages_survive_edited_words(spark):
    long = [f"t{k}" for k in range(40)]
    five = ["one", "two", "three", "four", "five"]
    a, b = long[5:15], long[20:30]
    texts = {
        1: a, 2: a[:4] + ["new"] + a[5:], 3: a[:3] + ["new"] + a[3:], 4: a[:6] + a[7:], 5: a[:3] + ["x"] + a[4:7] + ["y"] + a[8:],
        6: [*b[:2], "in", *b[2:8], "sert", *b[8:]], 7: five[:2] + ["zzz"] + five[3:], 8: long[:18] + ["odd"] + long[18:],
        9: a[:2] + ["x"] + a[3:5] + ["y"] + a[6:8] + ["z"] + a[9:], 10: a[::-1], 11: a[:5], 12: five[:1] + ["q", "r"] + five[3:], 13: a[:8],
    }
    rows = [(i, " ".join(["before", "it"] * 8 + t + ["and", "after"] * 8)) for i, t in texts.items()]
    docs = spark.createDataFrame([*rows, (99, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(five)), (3, None)], "item_id long, text string")
    got = {r.doc_id: r.near_items for r in decontamination.report(docs, items).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 4, 5, 6, 8, 13), "1"), 7: "2", **dict.fromkeys((9, 10, 11, 12, 99), "")}


def test_near_passages_come_out_of_a_query(spark):
    rows = queries.queries()["op3_near_passages"](spark, "/root/testdata/sf0.001").collect()
    assert all(not r.contaminated or r.near_items for r in rows) and any(r.contaminated for r in rows)


def test_long_books_are_kept_and_both_window_forms_agree(spark, monkeypatch):
    """No text is rejected by its length, and the form for very long texts counts as the packed one does."""
    rng = np.random.default_rng(2)
    words = np.array(["".join(w) for w in rng.choice(list("abcdefghijklm"), (40_000, 7))] + ["the", "of", "and", "to"] * 4_000)
    book = " ".join(rng.choice(words, 300_000))
    texts = [book, "a b c a b c a", "x y", "", None, " ".join(["the cat sat on it"] * 30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = {r.doc_id: r for r in quality_rules.apply_rules(frame).collect()}
    assert packed[0].kept and packed[0].n_words == 300_000
    monkeypatch.setattr(quality_rules, "_AT_BITS", 1)
    assert {r.doc_id: r for r in quality_rules.apply_rules(frame).collect()} == packed
