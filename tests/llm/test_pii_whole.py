"""Added spans against brute force, and texts without limit of length or of matches."""

import random
import re
import time

from txnwatch.llm import pii
from txnwatch.llm.pii import BASE, Model, Tree

SF = "/root/testdata/sf0.01"
MODEL = Model(0.0, (Tree(("digits", 3), ("separators", 1), (-1.0, 0.125, 0.5, 0.25)), Tree(("quoted", 1), ("generator", 2), (0.0, 0.25, 0.125, 0.375))), 0.25)


def _features(g, s, before):
    nd, nl = len(re.findall("[0-9]", s)), len(re.findall("[A-Za-z]", s))
    other = len(s) - nd - nl
    return {"generator": g, "digits": 0 if nd == 0 else sum(nd >= b for b in (1, 7, 10, 13, 16, 20)), "letters": (nl > 0) + (nl >= 5),
            "separators": (other > 0) + (other >= 3), "hexadecimal": int(bool(re.fullmatch("[0-9A-Fa-f]+", s))),
            "quoted": int(before[-1:] in ("'", '"') and before != ""), "plus": int(s.startswith("+")), "at": int("@" in s),
            "dots": int(bool(re.search("[.][0-9]+[.]", s)))}


def _runs(text):
    """Proposals by hand: every maximal run of each generator that has the digits and the edges it asks for."""
    for m in re.finditer(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]+(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]+)*", text):
        yield 0, m.start(), m.end()
    for m in re.finditer(r"(?<![A-Za-z0-9])[+(]?[0-9](?:[\x20().-]{0,2}[0-9])*", text):
        if len(re.findall("[0-9]", m[0])) >= 7 and not re.match("[A-Za-z0-9]", text[m.end():m.end() + 1]):
            yield 1, m.start(), m.end()
    for m in re.finditer("[A-Za-z0-9_-]+", text):
        if len(m[0]) >= 16 and re.search("[0-9]", m[0]):
            yield 2, m.start(), m.end()


def _added(text, base, model):
    scored = []
    for g, a, b in _runs(text):
        if not any(x < b and a < y for x, y in base):
            f = _features(g, text[a:b], text[max(a - 24, 0):a])
            score = model.start + sum(t.value(f) for t in model.trees)
            if score >= model.threshold:
                scored.append((score, b - a, -a, a, b))
    return sorted({(a, b) for s in scored for *_, a, b in [s] if not any(o[3] < b and a < o[4] and o[:3] > s[:3] for o in scored)})


def _texts(seed, n):
    draw = random.Random(seed)
    bits = ["a@b", "x.y [at] host [dot] org", "+1 (614) 555-8001", "1 2 3 4 5 6 7 8", "12345678x", "555.123.4567", "tok_9f8e7d6c5b4a39281706", "A" * 20 + "7", "'", '"', " ", ",", "\n",
            "10.0.0.1", "4111 1111 1111 1111", "é", "key: ", "0" * 30, "-", "word", "2024-01-15", "9" * 300, "p-" * 30 + "3"]
    return ["".join(draw.choice(bits) for _ in range(draw.randrange(0, 120))) for _ in range(n)] + ["", None]


def test_added_spans_against_brute_force(spark):
    texts = _texts(3, 150)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    total = 0
    for r in pii.find(frame, MODEL).collect():
        text = r._row.text or ""
        base = [(x.start, x.end) for k in BASE for x in r[k]]
        for k in BASE:
            assert [x.s for x in r[k]] == [text[x.start:x.end] for x in r[k]]
        want = _added(text, base, MODEL)
        assert [(x.start, x.end) for x in r.added] == want, text
        total += len(want)
    assert total > 200


def test_a_text_of_a_hundred_thousand_matches(spark):
    text = "".join(f"u{i}@h{i % 97}.org 10.0.{i % 200}.1\n" for i in range(50_000)) + "1 2 3 4 5 6 7 " * 20_000 + "9x"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    row = pii.report(frame, model=MODEL).first()
    assert (row.n_email, row.n_ip) == (50_000, 50_000) and row.n_added == 0
    assert time.time() - began < 90
    last = [s for s in row.spans.split(",") if s.startswith("email")][-1].split(":")
    assert text[int(last[1]):int(last[2])] == "u49999@h44.org"


def test_long_secrets_and_planted_ones_are_found(spark):
    """Secrets planted in half of the documents behind a cue teach the trees; those planted without a cue are then found."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(400).collect()]
    draw = random.Random(11)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    planted, rows = {}, []
    for i, (doc_id, text) in enumerate(docs):
        secret = "sk_" + "".join(draw.choice(alphabet) for _ in range(5000 if i % 40 < 2 else 32)) + "7"
        start = len(text) + len(" token " if i % 2 == 0 else " see ")
        rows.append((doc_id, text + (" token " if i % 2 == 0 else " see ") + secret))
        if i % 2:
            planted[doc_id] = (start, start + len(secret))
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), pii.fit(spark.createDataFrame(rows, "doc_id long, text string"), precision=0.4)).collect()
    spans = {r._row.doc_id: {(x.start, x.end) for x in r.added} for r in found}
    assert sum(p in spans[d] for d, p in planted.items()) >= 0.98 * len(planted)
