"""Top-k search, hard negatives and the filter audit against brute force, and their behaviour on odd rows."""

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnwatch.llm import filter_audit, hard_negatives, top_k, vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def integers(row):
    return tuple(math.floor(256 * x) for x in row)


def product(a, b):
    return sum(x * y for x, y in itertools.zip_longest(a, b, fillvalue=0))


def taking_part(rows):
    """id -> (label, vector) by the rule of the module."""
    found = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        found[i] = min(found.get(i, (label, integers(v))), (label, integers(v)))
    return found


def expected_top(rows, every, k):
    found = taking_part([(i, v, 0) for i, v, _ in rows])
    out = []
    for q in found:
        if q % every == 0:
            best = sorted((-product(found[q][1], v), i) for i, (_, v) in found.items() if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def expected_negatives(rows, every, n_positives, n_negatives, least):
    found = taking_part(rows)
    out = []
    for a, (label, va) in found.items():
        if a % every:
            continue
        ranked = sorted((-product(va, v), i, other) for i, (other, v) in found.items() if i != a)
        for p_score, p, _ in [x for x in ranked if x[2] == label][:n_positives]:
            window = [x for x in ranked if x[2] != label and least * -p_score <= 100 * -x[0] <= 100 * -p_score][:n_negatives]
            out += [(a, p, r, i, -p_score, -s) for r, (s, i, _) in enumerate(window, 1)]
    return sorted(out)


def random_rows(seed, n, width, copies=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, width)) / 4
    v[rng.random(v.shape) < 0.3] = 0
    if copies:
        v[5 : 5 + copies] = v[5]
    return [(int(i), [float(np.float32(x)) for x in row], int(rng.integers(0, 3))) for i, row in enumerate(v)]


ODD = [
    (None, [0.5, 0.5], 1), (200, None, 1), (201, [0.5, None], 1), (202, [float("nan"), 0.5], 1), (203, [float("inf"), 0.5], 1),
    (204, [0.5], 0), (205, [], 0), (206, [0.25, 0.5, 0.125], None), (207, [0.5, 0.25], 1), (207, [0.5, 0.25], 1), (207, [0.75, 0.25], 1), (200, [-0.5, 0.25], 2),
]


@pytest.mark.parametrize("rows", [random_rows(1, 120, 8), random_rows(2, 150, 3, copies=70), ODD, ODD + random_rows(3, 60, 2), random_rows(4, 1, 4)])
def test_search_against_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, VECTORS)
    got = sorted(map(tuple, top_k.search(docs, every=10, k=4).collect()))
    assert got == expected_top(rows, 10, 4)
    got = sorted(map(tuple, hard_negatives.mine(docs, every=10, positives=3, negatives=4, least=60).collect()))
    assert got == expected_negatives(rows, 10, 3, 4, 60)


def test_many_cells_give_the_same(spark, monkeypatch):
    rows = random_rows(5, 300, 8, copies=100)
    docs = spark.createDataFrame(rows, VECTORS)
    monkeypatch.setattr(vectors.parts, "__defaults__", (200,))
    monkeypatch.setattr(vectors.meet, "__defaults__", (200,))
    assert vectors.parts(vectors.integer_vectors(docs), 200) > 10
    assert sorted(map(tuple, top_k.search(docs, every=5).collect())) == expected_top(rows, 5, 5)
    assert sorted(map(tuple, hard_negatives.mine(docs, every=20).collect())) == expected_negatives(rows, 20, 5, 5, 80)


def test_search_of_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert top_k.search(empty).collect() == [] and hard_negatives.mine(empty).collect() == []
    rows = random_rows(6, 40, 4)
    clash = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS id", "1 AS v", "2 AS rank", "3 AS score", "4 AS block", "5 AS shard", "6 AS row")
    assert sorted(map(tuple, top_k.search(clash, every=10).collect())) == expected_top(rows, 10, 5)
    assert sorted(map(tuple, hard_negatives.mine(clash, every=10).collect())) == expected_negatives(rows, 10, 5, 5, 80)


@pytest.mark.parametrize("top", [3, 1000, 2**31, 2**45])
def test_shard_search_is_exact_at_every_size_of_number(top):
    rng = np.random.default_rng(top)
    for trial in range(60):
        n, d, k = int(rng.integers(1, 50)), int(rng.integers(0, 6)), int(rng.integers(1, 6))
        m, q = rng.integers(-top, top + 1, (n, d)), rng.integers(-top, top + 1, d)
        m[rng.random(m.shape) < 0.4] = 0
        if trial % 3 == 0:
            m, q = abs(m), abs(q)
        ids, labels = rng.permutation(n) * 3, rng.integers(0, 3, n)
        scores = [sum(int(a) * int(b) for a, b in zip(q, row)) for row in m]
        (query,), rows = vectors.exact(q[None], m)
        at, got = top_k.Shard(ids, rows, 16).search(query, int(ids[0]), k)
        assert [(-int(s), int(ids[a])) for a, s in zip(at, got)] == sorted((-s, int(i)) for s, i in zip(scores, ids) if i != ids[0])[:k]
        windows = [(None, None), (-5, 5), (min(scores), scores[0]), (4, 2)]
        for (low, high), (at, got) in zip(windows, hard_negatives.Lists(ids, labels, rows).first(query, labels != 1, windows, k)):
            inside = [(-s, int(i)) for s, i, x in zip(scores, ids, labels) if x != 1 and (low is None or low <= s <= high)]
            assert [(-int(s), int(ids[a])) for a, s in zip(at, got)] == sorted(inside)[:k]


def test_non_essential_terms_are_left_out():
    """A term whose bound is small is only probed for candidates that an essential term has brought up."""
    rows = np.zeros((4000, 3))
    rows[:, 0] = 1
    rows[::100, 1] = 1000
    shard = top_k.Shard(np.arange(4000), rows)

    class Watched(list):
        read = 0

        def __getitem__(self, t):
            Watched.read += t == 0
            return super().__getitem__(t)

    shard.values = Watched(shard.values)
    at, scores = shard.search(np.array([1.0, 1.0, 0.0]), -1, 1)
    assert at.tolist() == [0] and scores.tolist() == [1001]
    assert Watched.read == 1  # in the first step only, before there is a threshold


DOCS = "doc_id long, text string, source string"
LONG = " ".join(f"word{i}" for i in range(250))


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text))]


def expected_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    parts = defaultdict(list)
    for i, t, s in docs:
        parts[s or ""].append((i, [*fails(t or ""), i is not None and i > first[t or ""]]))
    out = []
    for part, members in parts.items():
        shapley = Counter()
        rows = []
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, name in enumerate(order, 1):
                f = "ABCDE".index(name)
                removed, kept = [m for m in left if m[1][f]], [m for m in left if not m[1][f]]
                failing = [m for m in members if m[1][f]]
                shapley[name] += len(removed)
                rows.append(["".join(order), step, name, len(kept), len(removed), len(failing) - len(removed), sum(sum(m[1]) == 1 for m in failing),
                             sum(m[0] in good for m in removed), sum(m[0] in toxic for m in removed)])
                left = kept
        out += [(part, o, s, *rest, shapley[n]) for o, s, n, *rest in rows]
    return sorted(out)


def test_audit_against_brute_force(spark):
    texts = [LONG, LONG + " #", LONG.upper(), "a b c", "", None, "x " * 300, LONG + " SHORT", "Ä" * 50, LONG + "\x0b\r\n$", LONG * 40]
    docs = [(i, texts[i % len(texts)], ["s", "t", None, ""][i % 4]) for i in range(88)]
    docs += [(100, LONG, "s"), (100, LONG, "s"), (100, "other", "t"), (None, LONG, "s"), (None, "lone", "u")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 88, 2)] + [(2, 1, None), (3, None, None), (3, None, 1), (None, 1, 1), (999, 1, 1)]
    d, m = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(d.selectExpr("*", "1 AS mask", "2 AS h", "3 AS digest", "4 AS part", "5 AS n", "6 AS good"), m)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == expected_audit(docs, labels)


def test_audit_of_empty_tables(spark):
    none, marks = spark.createDataFrame([], DOCS), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(none, marks).collect() == []
    got = filter_audit.audit(spark.createDataFrame([(1, None, None)], DOCS), marks).collect()
    assert len(got) == 600 and {r["part"] for r in got} == {""}
    assert {r["removed"] for r in got if r["filter_order"].index("A") == r["step"] - 1} == {1}


def test_a_full_sketch_still_gives_the_exact_repeats(spark, monkeypatch):
    """With far too few counters nothing is cleared; with enough, unique texts are, and the result is the same."""
    docs = spark.createDataFrame([(i, f"text {i % 700}", "s") for i in range(900)], DOCS)
    wide = Counter(r["mask"] & 16 for r in filter_audit.flagged(docs).collect())
    monkeypatch.setattr(filter_audit, "counters_for", lambda n: 64)
    monkeypatch.setattr(filter_audit, "SEGMENT", 32)
    assert Counter(r["mask"] & 16 for r in filter_audit.flagged(docs).collect()) == wide == {0: 700, 16: 200}


def test_the_sketch_clears_most_unique_texts_and_no_repeat(spark):
    docs = spark.createDataFrame([(i % 3000,) for i in range(3500)], "t long").select(F.xxhash64("t").alias("h"))
    rows = docs.select("h", filter_audit.possible_repeat(docs, filter_audit.counters_for(3500)).alias("maybe")).collect()
    often = Counter(r["h"] for r in rows)
    assert all(r["maybe"] for r in rows if often[r["h"]] > 1)
    assert sum(r["maybe"] for r in rows if often[r["h"]] == 1) < 50
