"""Each training-data operator against brute force or SQL on small inputs, and all of them on odd rows."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from txnwatch.llm import chunk_dedup, decontamination, language_id, line_dedup, mixing, ngram_join, pii, quality_model, quality_rules, queries, suffix_dedup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, words int, _row int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated rows, ties, and columns named like the operators' own."""
    rng = random.Random(5)
    prose = [" ".join("".join(rng.choices("aeioulnrst", k=rng.randint(2, 9))) for _ in range(80)) + "." for _ in range(4)]
    texts = [None, "", " \n\t ", "x", prose[0], prose[0], prose[1], prose[1] + " end", "word " * 20_000, "é" * 300, "\n".join(["same line here"] * 6), prose[2] + "\n" + prose[3], "a@b.cd 1.2.3.4 +1 (614) 555-8001"]
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, None, "k", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[4], (None, prose[0], "fr", None, None, None, None, None), (None, prose[3], None, "s", None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.queries()[name](spark, SF).toPandas()
    want = con.sql(queries.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got[columns].values.tolist())) == sorted(map(tuple, want[columns].values.tolist()))


def _gear_chunks(b):
    s, out = 0, []
    while s < len(b):
        e = min(s + chunk_dedup.MOST, len(b))
        for t in range(s + chunk_dedup.LEAST - 1, e):
            h = sum(int(chunk_dedup._GEAR[b[u]]) << (t - u) for u in range(max(0, t - 31), t + 1)) & 0xFFFFFFFF
            if h >> 27 == 0:
                e = t + 1
                break
        out.append((s, e))
        s = e
    return out


def test_chunk_dedup_keeps_the_first_of_equal_chunks(spark, docs):
    rows = sorted((r.doc_id, r.text.encode()) for r in docs.where("length(text) < 4000").collect())[:90]
    rows += [(10_000 + i, b) for i, (_, b) in enumerate(rows[:10])]
    frame = spark.createDataFrame([(i, b.decode()) for i, b in rows], "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in chunk_dedup.strip_repeats(frame).collect()}
    first, want = {}, {}
    for i, b in rows:
        runs = []
        for s, e in _gear_chunks(b):
            if first.setdefault(b[s:e], (i, s)) != (i, s):
                if runs and runs[-1][1] == s:
                    runs[-1][1] = e
                else:
                    runs.append([s, e])
        kept, last = b"", 0
        for s, e in (r for r in runs if r[1] - r[0] >= chunk_dedup.RUN):
            kept, last = kept + b[last:s], e
        kept += b[last:]
        want[i] = (len(b) - len(kept), hashlib.sha256(kept).hexdigest())
    assert got == want and sum(n > 0 for n, _ in want.values()) >= 10


def test_chunks_resist_an_insertion():
    data = np.random.default_rng(3).integers(97, 123, 20_000).astype(np.uint8)
    moved = np.concatenate([data[:7000], np.frombuffer(b"inserted", np.uint8), data[7000:]])
    cuts = [{x[s:e].tobytes() for s, e in zip(*chunk_dedup.cut_points(x, np.array([0, len(x)])), strict=True)} for x in (data, moved)]
    assert len(cuts[1] - cuts[0]) <= 6


def _repeated(rows, span=suffix_dedup.SPAN):
    count = Counter(b[s : s + span] for _, b in rows for s in range(len(b) - span + 1))
    out = []
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - span + 1):
            if count[b[s : s + span]] > 1:
                gone[s : s + span] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 3, 0])
def test_suffix_dedup_is_exact(spark, docs, crowd):
    """Strings with few contexts are decided in a task, those over ``crowd`` are dealt over tasks: the same result."""
    rng = random.Random(7)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    passage = "".join(rng.choices("abcdefgh ", k=260))
    noise = ["".join(rng.choices("ijklmnop ", k=400)) for _ in range(14)]
    rows += [(1000 + k, n[:150] + passage[k : 198 + k + k % 5] + n[150:]) for k, n in enumerate(noise)]  # near the threshold, shifted
    rows += [(2000, "ab" * 300), (2001, "abc" * 200), (2002, noise[0]), (2003, noise[0][:199]), (2004, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.strip_repeated(frame, crowd=crowd).collect())
    assert got == sorted(_repeated([(i, (t or "").encode()) for i, t in rows]))


def test_multikey_order_sorts_like_bytes():
    rows = np.random.default_rng(1).integers(97, 99, (300, 24)).astype(np.uint8)
    order = suffix_dedup.multikey_order(rows.view(">u8").astype(np.uint64))
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_join_counts_links_over_many_blocks(spark, monkeypatch):
    """A group of near copies larger than a block, against brute force; recall of the bands is next to one."""
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(2)
    base = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(120), i % 5):
            words[k] = f"w{i}x{k}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: (r.n_links, r.group_id) for r in ngram_join.similarity_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {t: {tuple(t.split()[k : k + 5]) for k in range(116)} for _, t in rows}
    want = {i: sum(1 for u in sets if u != t and len(sets[t] & sets[u]) >= 0.8 * len(sets[t] | sets[u])) for i, t in rows}
    assert {i: n for i, (n, _) in got.items()} == want
    assert got[0][1] == 0 and ngram_join.band_count(0.8, 0.9998, 6) == 29


def test_language_accuracy_on_held_out_documents(docs):
    rows = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _valid(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def test_personal_data_base_spans(spark, docs):
    extra = ["a@b.com%x@y.z q@r", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.255.00255", "4111 1111-1111 1111, 41111111111111112 12345678901234567", "+1 (614) 555-8001 +44 20 7946 0958-- +1-2", "é x@y.zé ñ 10.0.0.1", "9" * 20_000, "a" * 20_000, "+1" + " " * 9_000 + "2 a.b@c@d.e.f..g@h.i", None, ""]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame([(100_000 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    got = {r.doc_id: r for r in pii.report(frame).collect()}
    for r in frame.collect():
        spans = {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, r.text or "") if _valid(k, m[0])] for k, p in BASE.items()}
        flat = [s for k in BASE for s in spans[k]]
        row = got[r.doc_id]
        assert [row[f"n_{k}"] for k in BASE] == [len(spans[k]) for k in BASE], r
        assert row.base_sha256 == hashlib.sha256(",".join(flat).encode()).hexdigest()
        assert row.spans.split(",")[: len(flat)] == flat or not flat


def test_redaction_leaves_no_address(docs):
    hit = docs.where("text RLIKE '[a-z][.][0-9]+@'")
    out = pii.redact(hit)
    assert out.columns == docs.columns and out.where("text RLIKE '@mail'").count() == 0 and out.count() == hit.count()


def test_quality_em_ends_at_a_fixed_point():
    """Slow tables included: labellers that nearly always agree, and one whose votes tell little."""
    m = len(quality_model.LABELLERS)
    rng = np.random.default_rng(5)
    for noise in (0.02, 0.3, 0.49):
        truth = rng.random(20_000) < 0.5
        votes = np.where(rng.random((20_000, m)) < 0.3, 1, np.where((rng.random((20_000, m)) < noise) ^ truth[:, None], 2, 0))
        pattern, n = np.unique(quality_model._pattern(votes.astype(np.int64)), return_counts=True)
        post, accuracy = quality_model.expectation_maximisation(pattern, n * 1e6)
        v = quality_model._unpack(pattern)
        agreed, cast = (n * post) @ (v == 2) + (n * (1 - post)) @ (v == 0), n @ (v != 1)
        again = np.clip((agreed + quality_model.START * cast / 2) / (cast * 1.5), 0.55, 0.999)
        assert np.abs(again - accuracy).max() < 1e-5


def test_quality_model_agrees_with_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").dropDuplicates(["doc_id"])
    rows = quality_model.classify(docs).join(labels, "doc_id").collect()
    assert sum(r.kept == bool(r.quality) for r in rows) >= 0.9 * len(rows)


def test_weak_labels_find_a_poor_labeller():
    rng = np.random.default_rng(4)
    m = len(quality_model.LABELLERS)
    good = rng.random(4000) < 0.5
    v = np.ones((4000, m), int)
    for k in range(m):
        right = rng.random(4000) < (0.6 if k == 2 else 0.95)
        v[:, k] = np.where(right == good, 2, 0)
    pattern, n = np.unique(v @ 3 ** np.arange(m), return_counts=True)
    _, accuracy = quality_model.expectation_maximisation(pattern, n.astype(float))
    assert accuracy.argmin() == 2 and accuracy[2] < 0.8 < min(np.delete(accuracy, 2))


def test_rates_meet_the_targets(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = mixing.mixed(docs, labels).toPandas()
    total = out.n_words.sum()
    assert (out.rate >= 0).all() and out.rate.max() < 1000
    for d, share in mixing.TARGETS.items():
        assert abs((out.n_words * out.rate * out[f"p_{d}"]).sum() / total - share * mixing.BUDGET) < 0.02


def test_pipeline_against_brute_force_stages(spark, docs):
    """The filters by set arithmetic on what each stage was given; the mixture by its own counts."""
    kept = corpus_pipeline.quality(spark, docs, SF)
    verdict = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, k in verdict.items() if k}
    cleaned = corpus_pipeline.lines(spark, kept, SF).cache()
    pages, by_line, seen = defaultdict(set), defaultdict(set), kept.collect()
    for r in seen:
        pages[r.source].add(r.text)
        for x in r.text.split("\n"):
            by_line[r.source, x.strip(" ")].add(r.text)
    drop = {k for k, v in by_line.items() if k[1].strip() and len(v) >= line_dedup.MIN_PAGES and len(v) > line_dedup.MAX_RATIO * len(pages[k[0]])}
    assert {r.doc_id: r.text for r in cleaned.collect()} == {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in drop) for r in seen}
    single = corpus_pipeline.near_duplicates(spark, cleaned, SF).cache()
    groups = {r.group_id for r in ngram_join.similarity_join(cleaned).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(groups)
    clean = corpus_pipeline.decontaminate(spark, single, SF).cache()
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in decontamination.report(single, items).collect() if not r.contaminated}
    mix = corpus_pipeline.mix(spark, clean, SF)
    assert mix.columns == [*docs.columns, "rate", "copies", "unreachable"] and mix.where("copies < 1").count() == 0
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]


def _all(spark, docs):
    labels = spark.createDataFrame([(4, 1, 0), (8, 0, 0), (10, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "word word word"), (2, None), (3, ""), (None, "end")], "item_id long, text string")
    yield "join", ngram_join.similarity_join(docs)
    yield "rules", quality_rules.apply_rules(docs)
    yield "decontamination", decontamination.report(docs, items)
    yield "chunks", chunk_dedup.strip_repeats(docs)
    yield "suffixes", suffix_dedup.strip_repeated(docs)
    yield "model", quality_model.classify(docs)
    yield "language", language_id.identify(docs)
    yield "lines", line_dedup.drop_boilerplate(docs)
    yield "personal", pii.report(docs)
    yield "mixing", mixing.mixed(docs, labels)
    yield "redact", pii.redact(docs)


def test_odd_rows_get_a_row_each(spark, odd):
    n = odd.count()
    for name, out in _all(spark, odd):
        rows = out.collect()
        assert len(rows) == n, name
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in odd.collect()), name
    found = {r.doc_id: r for r in ngram_join.similarity_join(odd).collect()}
    assert found[0].class_id == found[1].class_id == 0 and found[5].class_id == 4 and found[4].n_copies == 4
    assert found[6].n_links == found[7].n_links == 1 and found[7].group_id == 6
    assert {r.doc_id: r.lang_pred for r in language_id.identify(odd).collect()}[0] == "und"


def test_odd_rows_through_the_stages(spark, odd):
    rows = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns, name
        assert out.count() <= odd.count()
    kept = sorted(str(r.doc_id) for r in corpus_pipeline.near_duplicates(spark, rows, SF).collect())
    assert kept == sorted(map(str, [0, 2, 3, 4, 6, 8, 9, 10, 11, 12, None])) or len(kept) == len(set(kept))


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    for name, out in _all(spark, none):
        assert out.collect() == [], name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).collect() == [], name


@pytest.mark.parametrize("crowd", [suffix_dedup.CROWD, 20, 0])
def test_neighbours_are_found_across_pieces_and_partitions(spark, monkeypatch, crowd):
    """A passage with many different surroundings, in pieces of four suffixes or more."""
    whole, decide = suffix_dedup._neighbours, suffix_dedup._decide
    monkeypatch.setattr(suffix_dedup, "_neighbours", lambda batches, width: whole(batches, width, bucket=4))
    monkeypatch.setattr(suffix_dedup, "_decide", lambda batches, span, gram: decide(batches, span, gram, bucket=4))
    rng = random.Random(11)
    passage = "".join(rng.choices("abcdefgh ", k=230))
    rows = [(k, "".join(rng.choices("ijklmnop ", k=250)) + passage + "".join(rng.choices("qrstuvwx ", k=250))) for k in range(80)]
    rows += [(100, passage[:199]), (101, "y" * 100 + passage[:199]), (102, passage[10:210] + "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.strip_repeated(frame, crowd=crowd).collect())
    assert got == sorted(_repeated([(i, t.encode()) for i, t in rows]))


def test_chunks_are_cut_out_in_small_pieces():
    """A batch of long texts goes back as several, each about a block, with the same rows."""
    import hashlib

    import pyarrow as pa

    from txnwatch.llm.chunk_dedup import PLACE, _strip

    texts = [None, "x" * 700_000, "", "y" * 700_000, "z" * 700_000, "ab" * 100]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts), pa.array([None, [], None, [0 * PLACE + 150], [], [0 * PLACE + 120]], pa.list_(pa.int64()))], ["doc_id", "text", "again"])
    out = list(_strip(iter([batch.slice(0, 6)]), 100))
    assert len(out) > 1 and [d for b in out for d in b.column("doc_id").to_pylist()] == list(range(6))
    want = [b"", b"x" * 700_000, b"", b"y" * 699_850, b"z" * 700_000, b"ab" * 40]
    assert [k for b in out for k in b.column("kept").to_pylist()] == want
    assert [k for b in out for k in b.column("kept_sha256").to_pylist()] == [hashlib.sha256(x).hexdigest() for x in want]
    assert [n for b in out for n in b.column("n_removed").to_pylist()] == [0, 0, 0, 150, 0, 120]
