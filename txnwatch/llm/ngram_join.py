"""N-gram Jaccard join: MinHash banding finds candidates, whole n-gram sets verify them.

1. Each distinct text gets MinHash values of its word n-grams, hashed by bands (Arrow batches, vectorised).
2. Band buckets with two texts or more are formed by a shuffle on the band hashes. In a bucket, texts are compared by
   short signature sketches, and those that may be similar are linked by a star: no list of pairs ever exists.
3. Components of these stars bound where links can be. Their members send their whole n-gram sets, and every pair in a
   component is compared once, exactly; per text only its number of links and a star edge leave the task.
Buckets and components of any size are dealt into blocks of about BLOCK texts, and a task holds one pair of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import blocks, buffers, constants, cut, mix, split_join, text_key, word_hashes
from txnwatch.llm.components import connected

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.9998
ROWS = 6
BLOCK = 768


def band_count(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of ``rows`` values with which a pair of exactly ``similarity`` meets with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of several documents, with repeats, and their n + 1 offsets; fewer words are one n-gram."""
    words, at = word_hashes(data, offsets)
    count = np.diff(at)
    short = (count > 0) & (count < n)
    size = np.where(short, 1, np.maximum(count - n + 1, 0))
    to = np.concatenate([[0], np.cumsum(size)])
    start = np.arange(to[-1]) + np.repeat(at[:-1] - to[:-1], size)
    end = np.repeat(at[1:], size)
    out = np.zeros(len(start), np.uint64)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    with np.errstate(over="ignore"):
        for k, c in enumerate(constants(n, 3)):
            out += np.where(start + k < end, padded[start + k], np.uint64(k + 1)) * c
    return mix(out), to


def _signatures(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    a, b = constants(bands * rows, 1), constants(bands * rows, 2)
    weights = constants(rows, 4)
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        hashes, sketches, sizes = [], [], []
        for i, j in blocks(offsets, 1 << 19):
            grams, at = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
            full = np.flatnonzero(np.diff(at))
            low = np.zeros((bands * rows, j - i), np.uint64)
            if len(full):
                v = np.empty_like(grams)
                with np.errstate(over="ignore"):
                    for k in range(bands * rows):
                        np.multiply(grams, a[k], out=v)
                        np.add(v, b[k], out=v)
                        low[k, full] = np.minimum.reduceat(v, at[full])
            with np.errstate(over="ignore"):
                band = mix((low.reshape(bands, rows, -1) * weights[None, :, None]).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)[:, None])
                sketches.append((mix(low) & np.uint64(255)).astype(np.uint8).T)
            hashes.append(band.T)
            sizes.append(np.diff(at))
        m = batch.num_rows
        flat = np.concatenate(hashes) if hashes else np.zeros((0, bands), np.uint64)
        sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * bands), pa.array(np.ascontiguousarray(flat).view(np.int64).ravel()))
        raw = np.concatenate(sketches).tobytes() if sketches else b""
        wide = bands * rows
        binary = pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(np.arange(m + 1, dtype=np.int32) * wide), pa.py_buffer(raw)])
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("rep"), pa.array(sizes.astype(np.int64)), lists, binary], ["key", "rep", "n_grams", "bands", "sketch"])


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes, the least index that the edges (i, j) connect it to."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            break
        keep = root[i] != root[j]
        i, j = i[keep], j[keep]
    return root


def _grouped(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups, and the starts of their groups, from rows that are sorted by ``names``."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        ids = np.stack([np.asarray(held.column(c)) for c in names])
        starts = np.concatenate([[0], np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1])
        if len(starts) > 1:
            yield held.slice(0, starts[-1]), starts[:-1]
            held = held.slice(starts[-1])
    if held is not None:
        ids = np.stack([np.asarray(held.column(c)) for c in names])
        yield held, np.concatenate([[0], np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1])


def _bucket_stars(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(u, v) edges that connect the texts of a bucket block whose sketches agree in a share of ``least``."""
    for table, starts in _grouped(batches, ["bucket", "bi", "bj"]):
        n = table.num_rows
        raw, at = buffers(table.column("sketch"))
        wide = int(at[1] - at[0])
        sketch = raw.reshape(n, wide)
        size = np.diff(np.append(starts, n))
        left = np.repeat(starts + size, size) - np.arange(n) - 1  # rows that follow in the group
        block, bi, bj = (np.asarray(table.column(c)) for c in ("block", "bi", "bj"))
        found_i, found_j = [], []
        for d in range(1, int(size.max())):
            for i in np.array_split(x := np.flatnonzero(left >= d), max(1, len(x) // 20_000)):
                i = i[(bi[i] == bj[i]) | (block[i] != block[i + d])]
                if len(i):
                    ok = (sketch[i] == sketch[i + d]).sum(axis=1) >= least * wide
                    found_i.append(i[ok])
                    found_j.append(i[ok] + d)
        if found_i:
            root = _roots(n, np.concatenate(found_i), np.concatenate(found_j))
            u = np.flatnonzero(root != np.arange(n))
            key = table.column("key").combine_chunks()
            yield pa.RecordBatch.from_arrays([key.take(pa.array(u)), key.take(pa.array(root[u]))], ["u", "v"])


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        out = []
        for i, j in blocks(offsets):
            grams, at = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
            out += [np.unique(grams[x:y]).tobytes() for x, y in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("comp"), batch.column("g"), pa.array(out, pa.binary())], ["key", "comp", "g", "grams"])


def _links(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """For every text of a block pair: its links there and the least text that these links connect it to."""
    for table, starts in _grouped(batches, ["comp_hash", "bi", "bj"]):
        keys = table.column("key").combine_chunks()
        raw, at = buffers(table.column("grams"))
        block, bi, bj = (np.asarray(table.column(c)) for c in ("block", "bi", "bj"))
        out_key, out_root, out_n = [], [], []
        for s, e in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
            rows = np.arange(s, e)
            _, first = np.unique(np.array([keys[int(r)].as_py() for r in rows], "S16"), return_index=True)
            rows = rows[first]
            sets = [raw[at[r] : at[r + 1]].view(np.uint64) if at[r] % 8 == 0 else np.frombuffer(raw[at[r] : at[r + 1]].tobytes(), np.uint64) for r in rows]
            size = np.array([len(x) for x in sets])
            owner = np.repeat(np.arange(len(rows)), size)
            _, gram, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            shared = times[gram] > 1
            _, column = np.unique(gram[shared], return_inverse=True)
            owner = owner[shared]
            both = np.zeros((len(rows), len(rows)), np.float32)
            order = np.argsort(column, kind="stable")
            column, owner = column[order], owner[order]
            for c in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
                x, y = np.searchsorted(column, [c, c + 4096])
                m = np.zeros((len(rows), 4096), np.float32)
                m[owner[x:y], column[x:y] - c] = 1
                both += m @ m.T
            ok = both >= similarity * (size[:, None] + size[None, :] - both) - 1e-3
            ok &= both > 0
            np.fill_diagonal(ok, False)
            if bi[s] != bj[s]:
                ok &= block[rows][:, None] != block[rows][None, :]
            i, j = np.nonzero(ok)
            root = _roots(len(rows), i, j)
            out_key += [keys[int(r)].as_py() for r in rows]
            out_root += [keys[int(rows[r])].as_py() for r in root]
            out_n += ok.sum(axis=1).tolist()
        yield pa.RecordBatch.from_arrays([pa.array(out_key, pa.binary()), pa.array(out_root, pa.binary()), pa.array(out_n, pa.int64())], ["key", "root", "n"])


def _block_pairs(df: DataFrame, key: str, size: str) -> DataFrame:
    """Deals the rows of a group into blocks by a hash of their key; each row goes to every pair (bi, bj) of its block."""
    df = df.withColumn("_g", F.ceil(F.col(size) / F.lit(BLOCK)).cast("int")).withColumn("block", F.pmod(F.xxhash64(key), F.col("_g")).cast("int"))
    df = df.withColumn("_o", F.explode(F.expr("CASE WHEN _g = 1 THEN array(0) ELSE sequence(0, _g - 1) END")))
    return df.withColumn("bi", F.least("block", "_o")).withColumn("bj", F.greatest("block", "_o")).drop("_g", "_o")


def _classes(keyed: DataFrame, n: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """key, class_id, n_copies, n_links, group_id, group_key, n_grams: a row for each distinct text of ``keyed`` (doc_id, key, text)."""
    bands = band_count(similarity, recall, rows)
    texts = cut(keyed.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies")))

    signed = keyed.select("key", F.col("doc_id").alias("rep"), "text").mapInArrow(
        lambda it: _signatures(it, n, bands, rows), "key binary, rep long, n_grams long, bands array<long>, sketch binary"
    )
    signed = cut(signed.groupBy("key").agg(F.first("n_grams").alias("n_grams"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    in_bands = signed.where("n_grams > 0").select("key", F.explode("bands").alias("bucket"))
    full = in_bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = _block_pairs(split_join(in_bands, full, ["bucket"]), "key", "n").select("key", "bucket", "block", "bi", "bj")
    # A sketch byte agrees by chance once in 256; the margin is five standard deviations below the threshold.
    least = max(0.0, similarity - 5 * math.sqrt(similarity * (1 - similarity) / (bands * rows)))
    placed = split_join(members, signed.select("key", "sketch"), ["key"]).repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj")
    stars = placed.mapInArrow(lambda it: _bucket_stars(it, least), "u binary, v binary")

    comps = connected(stars)
    sizes = comps.groupBy("root").agg(F.count("*").alias("size"))
    active = split_join(comps, sizes, ["root"]).select(F.col("u").alias("key"), F.col("root").alias("comp"), "size")
    active = active.join(texts.select("key", "rep"), "key").withColumnRenamed("rep", "doc_id")
    whole = keyed.select("doc_id", "key", "text").alias("t").join(active.alias("a"), (F.col("t.key") == F.col("a.key")) & F.col("t.doc_id").eqNullSafe(F.col("a.doc_id")))
    whole = whole.select(F.col("t.key").alias("key"), "comp", F.col("size").alias("g"), "text")
    sets = whole.mapInArrow(lambda it: _sets(it, n), "key binary, comp binary, g long, grams binary")
    dealt = _block_pairs(sets, "key", "g").withColumn("comp_hash", F.xxhash64("comp"))
    dealt = dealt.select("key", "comp_hash", "block", "bi", "bj", "grams").repartition("comp_hash", "bi", "bj").sortWithinPartitions("comp_hash", "bi", "bj")
    links = cut(dealt.mapInArrow(lambda it: _links(it, similarity), "key binary, root binary, n long"))

    counts = links.groupBy("key").agg(F.sum("n").alias("n_links"))
    roots = connected(links.select(F.col("key").alias("u"), F.col("root").alias("v"))).withColumnRenamed("u", "key")
    found = texts.join(counts, "key", "left").join(roots, "key", "left").join(signed.select("key", "n_grams"), "key")
    found = found.withColumn("root", F.coalesce("root", "key"))
    # The representative of a group: least doc_id, a null one last.
    first = F.min(F.struct(F.col("rep").isNull().alias("none"), F.col("rep").alias("id"), F.col("key").alias("key"))).alias("first")
    groups = found.groupBy("root").agg(first).select("root", F.col("first.id").alias("group_id"), F.col("first.key").alias("group_key"))
    found = split_join(found, groups, ["root"])
    return cut(found.select("key", F.col("rep").alias("class_id"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), "group_id", "group_key", "n_grams"))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))


def similarity_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, class_id, n_copies, n_links, group_id, n_grams: a row for each row of ``docs``.

    class_id: least doc_id with the same text. n_links: other distinct texts whose sets of word n-grams (case and
    punctuation ignored) have a Jaccard similarity of ``similarity`` or more. group_id: least doc_id that links and copies
    connect it to. Null text is the empty one; a text without words has copies and no links; one of fewer words than n is
    one n-gram. A null doc_id orders last, so its class may be null; repeated rows get a row each and count as copies.
    """
    keyed = _keyed(docs, doc_id, text)
    found = _classes(keyed, **options).drop("group_key")
    return split_join(keyed.select("doc_id", "key"), found, ["key"]).select(F.col("doc_id").alias(doc_id), "class_id", "n_copies", "n_links", "group_id", "n_grams")


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group, that with the least doc_id, with all its columns.

    Of rows that share this doc_id and text one stays; a group whose ids are all null keeps one row, too.
    """
    found = _classes(_keyed(docs, doc_id, text), **options).where("key = group_key").select("key", "class_id")
    rows = docs.select(text_key(F.col(text)).alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    both = split_join(rows, found, ["key"]).where(F.col("_row").getField(doc_id).eqNullSafe(F.col("class_id")))
    return both.dropDuplicates(["key"]).select("_row.*")
