"""Suffix-array dedup: bytes covered by a string of SPAN bytes that also starts elsewhere are removed, exactly.

A suffix array of all byte positions would shuffle some twenty times the input. This one is sparse: each window of SPAN
bytes names one of its GRAM-byte strings, the one with the least hash (the first of several), so equal windows name the
same string at the same place. A named place with the bytes around it that its windows reach is a *suffix in context*.

1. Named strings that occur once in the corpus are dropped by a count; if all occurrences of one have one context, the
   windows of all of them are repeated.
2. The other distinct contexts are range-partitioned by their named string, by splitters that Spark samples. A bucket is
   sorted by multikey quicksort on 8-byte tokens twice: as suffixes forward from the string, and backward from it. The
   common prefixes of sorted neighbours cut each order into classes of equal prefixes of every length; a window of ``b``
   bytes ahead of the string is repeated where two contexts share a class of the first ``SPAN - b`` bytes forward and one
   of ``b`` bytes backward.
3. A string with more than CROWD distinct contexts is not held by one task. Its suffixes are range-partitioned themselves, in
   both directions, neighbours are compared also across bucket boundaries, and the windows that neighbours on both sides
   can match are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import blocks, buffers, cut, mix, prefix_hash, range_hash, small_side, split_join, stored, text_key

#: Bytes of a repeated string, and of the string that names it.
SPAN = 200
GRAM = 32
#: Distinct contexts of one named string that a task holds; a string with more is dealt over tasks.
CROWD = 1 << 15


def _least_of(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the index of its least; the choice depends on the window's values alone."""
    n = len(h) - width + 1
    # The index takes the low bits of the hash: the minimum carries it, and of equal top bits the first one wins.
    bits = np.uint64(int(len(h)).bit_length())
    x = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    x = np.concatenate([x, np.full(-len(h) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    behind = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    return (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def named(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Named places of several documents: doc, place, low and high (first and last window start that names it), h, c.

    h is the hash of the named string, c that of its context: the bytes from the first window's start to the last one's end.
    """
    size = np.diff(offsets)
    starts = np.arange(len(data))
    doc = np.repeat(np.arange(len(size)), size)
    starts = starts[offsets[doc + 1] - starts >= span] if len(data) else starts
    if not len(starts):
        none = np.zeros(0, np.int64)
        return {"doc": none, "place": none, "low": none, "high": none, "h": none.astype(np.uint64), "c": none.astype(np.uint64)}
    sums = prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    h = range_hash(sums, at, at + gram)
    place = _least_of(h, span - gram + 1)[starts]  # windows that cross documents are never asked for
    owner = doc[starts]
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    low, high, p = starts[first], starts[last], place[first]
    c = mix(range_hash(sums, low, high + span) ^ ((p - low).astype(np.uint64) << np.uint64(32)) ^ (high - low).astype(np.uint64))
    base = offsets[owner[first]]
    return {"doc": owner[first], "place": p - base, "low": low - base, "high": high - base, "h": h[p], "c": c}


def _places(batches: Iterator[pa.RecordBatch], span: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(h, c, key, at): at packs place, bytes of the context before it, and windows that name it less one."""
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        for i, j in blocks(offsets, 1 << 19):
            got = named(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], span, gram)
            at = got["place"] << 24 | (got["place"] - got["low"]) << 12 | (got["high"] - got["low"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(got["h"].view(np.int64)), pa.array(got["c"].view(np.int64)), batch.column("key").take(pa.array(got["doc"] + i)), pa.array(at)], ["h", "c", "key", "at"]
            )


def _contexts(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """A row for each wanted context, with its bytes."""
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        rows, h, c, at, n, bytes_ = [], [], [], [], [], []
        for k, wanted in enumerate(batch.column("wanted").to_pylist()):
            for x in wanted:
                place, before, more = x["at"] >> 24, x["at"] >> 12 & 4095, x["at"] & 4095
                low = offsets[k] + place - before
                rows.append(k)
                h.append(x["h"])
                c.append(x["c"])
                at.append(x["at"])
                n.append(x["n"])
                bytes_.append(data[low : low + more + span].tobytes())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(c, pa.int64()), batch.column("key").take(pa.array(rows)), pa.array(at, pa.int64()), pa.array(n, pa.int64()), pa.array(bytes_, pa.binary())], ["h", "c", "key", "at", "n", "context"])


def multikey_order(tokens: np.ndarray) -> np.ndarray:
    """Order of byte strings given as rows of big-endian 8-byte tokens: ties in one token are sorted by the next only."""
    order = np.arange(len(tokens))
    group = np.zeros(len(tokens), np.int64)
    tied = np.arange(len(tokens))
    for d in range(tokens.shape[1]):
        rows = order[tied]
        by = np.lexsort((tokens[rows, d], group[tied]))
        order[tied] = rows[by]
        value, part = tokens[order[tied], d], group[tied]
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (part[1:] != part[:-1])])
        group[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        open_ = ~new
        open_[:-1] |= ~new[1:]
        tied = tied[open_]
        if not len(tied):
            break
    return order


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the rows of two byte matrices."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _matrix(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``width`` bytes (padded with zeros) and their lengths."""
    size = np.minimum(np.diff(offsets), width)
    column = np.arange(width)
    inside = column[None, :] < size[:, None]
    out = np.zeros((len(size), width), np.uint8)
    out[inside] = raw[(offsets[:-1, None] + column[None, :])[inside]]
    return out, size


def common(a: bytes, b: bytes, width: int) -> int:
    """Length of the common prefix of two byte strings, ``width`` at most."""
    n = min(len(a), len(b), width)
    return next((k for k in range(n) if a[k] != b[k]), n)


def _neighbours(batches: Iterator[pa.RecordBatch], width: int, bucket: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """(h, c, back, reach, part, suffix): common prefix of each suffix with its neighbours in the sorted bucket.

    A partition comes in pieces of ``bucket`` rows, already split by Spark's range partitioning and its external sort on the
    leading token; rows with the same leading token stay in one piece. The task compares the last suffix of a piece with the
    first of the next, as two more rows (a suffix counts by its largest reach). Only the first and the last suffix of a
    partition leave it, with their number in ``part``, to be compared with those of the partitions beside it.
    """
    part = TaskContext.get().partitionId()
    names = ["h", "c", "back", "reach", "part", "suffix"]

    def piece(table: pa.Table) -> tuple[pa.Table, list[bytes]]:
        """The rows of ``names`` with no suffix yet, and the first and the last suffix."""
        raw, offsets = buffers(table.column("suffix"))
        rows, size = _matrix(raw, offsets, width)
        back = np.asarray(table.column("back")).astype(np.int64)
        tokens = np.concatenate([np.ascontiguousarray(rows).view(">u8").astype(np.uint64), size[:, None].astype(np.uint64)], axis=1)
        order = multikey_order(np.column_stack([back.astype(np.uint64), tokens]))
        same = np.minimum(_common(rows[order[:-1]], rows[order[1:]]), np.minimum(size[order[:-1]], size[order[1:]]))
        same = np.where(back[order[:-1]] == back[order[1:]], same, 0)
        reach = np.maximum(np.append(same, 0), np.append(0, same))
        n = len(order)
        out = table.select(names[:3]).take(pa.array(order))
        for name, column in zip(names[3:], (pa.array(reach.astype(np.int64)), pa.array(np.full(n, part, np.int64)), pa.nulls(n, pa.binary())), strict=True):
            out = out.append_column(name, column)
        return out, [table.column("suffix")[int(order[k])].as_py() for k in (0, -1)]

    def edge(row: pa.Table, reach: int, suffix: bytes | None) -> pa.Table:
        return row.set_column(3, "reach", pa.array([reach], pa.int64())).set_column(5, "suffix", pa.array([suffix], pa.binary()))

    def pieces() -> Iterator[pa.Table]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            while held.num_rows >= 2 * bucket:
                lead = np.asarray(held.column("lead"))
                later = np.flatnonzero(lead[bucket:] != lead[bucket - 1])
                if not len(later):
                    break  # one leading token: the piece grows with it
                at = bucket + int(later[0])
                yield held.slice(0, at)
                held = held.slice(at)
        if held is not None and held.num_rows:
            yield held

    before = None
    for table in pieces():
        out, (first, last) = piece(table)
        top, end = out.slice(0, 1), out.slice(out.num_rows - 1)
        yield from out.to_batches()
        if before is None:
            yield from edge(top, 0, first).to_batches()
        elif before[0].column("back")[0] == top.column("back")[0]:
            same = common(before[1], first, width)
            yield from edge(before[0], same, None).to_batches()
            yield from edge(top, same, None).to_batches()
        before = end, last
    if before is not None:
        yield from edge(before[0], 0, before[1]).to_batches()


def _windows(batches: Iterator[pa.RecordBatch], span: int, gram: int) -> Iterator[pa.RecordBatch]:
    """(w, id, key, start): the windows of a context that neighbours on both sides can match."""
    for batch in batches:
        data, offsets = buffers(batch.column("context"))
        raw = data.tobytes()
        at, ahead, behind, n = (np.asarray(batch.column(k)).astype(np.int64) for k in ("at", "ahead", "behind", "n"))
        place, before, more = at >> 24, at >> 12 & 4095, at & 4095
        # Window w of the context (0 .. more) has before - w bytes ahead of the string and the rest after it.
        first = np.maximum(0, before - np.maximum(behind - gram, 0))
        last = np.minimum(more, before + np.maximum(ahead, gram) - span)
        count = np.maximum(last - first + 1, 0)
        row = np.repeat(np.arange(len(at)), count)
        w = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        ident = mix(np.asarray(batch.column("h")).view(np.uint64) ^ mix(np.asarray(batch.column("c")).view(np.uint64)))
        key = pa.compute.if_else(pa.array(n[row] == 1), batch.column("key").take(pa.array(row)), pa.scalar(None, pa.binary()))
        start = (place - before)[row] + w
        at_raw = offsets[row] + w
        for i in range(0, len(row), 1 << 14):
            cut_ = slice(i, i + (1 << 14))
            yield pa.RecordBatch.from_arrays([pa.array([raw[x : x + span] for x in at_raw[cut_].tolist()], pa.binary()), pa.array(ident[row[cut_]].view(np.int64)), key[cut_], pa.array(start[cut_])], ["w", "id", "key", "start"])


def _ranks(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte rows, and the common prefix of each sorted row with the one before it (0 for the first)."""
    tokens = np.concatenate([np.ascontiguousarray(rows).view(">u8").astype(np.uint64), size[:, None].astype(np.uint64)], axis=1)
    order = multikey_order(tokens)
    same = np.minimum(_common(rows[order[:-1]], rows[order[1:]]), np.minimum(size[order[:-1]], size[order[1:]]))
    return order, np.append(0, same)


def _reach(order: np.ndarray, same: np.ndarray) -> np.ndarray:
    """For each row, its longest common prefix with a sorted neighbour."""
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(same, np.append(same[1:], 0))
    return out


def _shared(data: np.ndarray, start: np.ndarray, before: np.ndarray, more: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, b) of each window that two contexts share; ``start`` is a context's first byte in ``data``."""
    top = span - gram
    forward, n_forward = _rows(data, start + before, more - before + span, 1, -(-span // 8) * 8)
    backward, n_backward = _rows(data, start + before - 1, before, -1, -(-top // 8) * 8)
    (f_order, f_same), (b_order, b_same) = _ranks(forward, n_forward), _ranks(backward, n_backward)
    f_reach, b_reach = _reach(f_order, f_same), _reach(b_order, b_same)
    f_class, b_class = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for b in range(top + 1):
        rows = np.flatnonzero((f_reach >= span - b) & ((b_reach >= b) & (n_backward >= b)))
        if len(rows) < 2:
            continue
        f_class[f_order] = np.cumsum(f_same < span - b)
        b_class[b_order] = np.cumsum(b_same < b)
        pair = f_class[rows] * (len(start) + 1) + b_class[rows]
        by = np.argsort(pair, kind="stable")
        equal = pair[by][1:] == pair[by][:-1]
        twice = rows[by[np.append(equal, False) | np.append(False, equal)]]
        found.append((twice, np.full(len(twice), b)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _rows(data: np.ndarray, first: np.ndarray, size: np.ndarray, step: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``width`` bytes (padded with zeros) read from ``first`` forward or backward, and their lengths."""
    out = np.zeros((len(first), width), np.uint8)
    for column in range(width):
        inside = np.flatnonzero(size > column)
        out[inside, column] = data[first[inside] + step * column]
    return out, size


def _decide(batches: Iterator[pa.RecordBatch], span: int, gram: int, bucket: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """(key, start, end): spans of repeated windows in contexts that occur once; rows come grouped by their named string.

    A partition is taken in pieces of whole groups, ``bucket`` rows or more.
    """

    def pieces() -> Iterator[pa.Table]:
        held, rows, closed, last = [], 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h = np.asarray(batch.column("h"))
            new = np.flatnonzero(np.append(last is not None and h[0] != last, h[1:] != h[:-1]))
            if len(new):
                closed = rows + int(new[-1])
            held.append(batch)
            rows, last = rows + len(h), h[-1]
            if closed >= bucket:
                table = pa.Table.from_batches(held)
                yield table.slice(0, closed)
                held, rows, closed = table.slice(closed).to_batches(), rows - closed, 0
        if rows:
            yield pa.Table.from_batches(held)

    for table in pieces():
        table = table.combine_chunks()
        data, offsets = buffers(table.column("context"))
        at, n = (np.asarray(table.column(k)).astype(np.int64) for k in ("at", "n"))
        place, before, more = at >> 24, at >> 12 & 4095, at & 4095
        row, b = _shared(data, offsets[:-1], before, more, span, gram)
        row, b = row[n[row] == 1], b[n[row] == 1]
        by = np.lexsort((b, row))
        row, b = row[by], b[by]
        if len(row):
            new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (b[1:] != b[:-1] + 1)))
            low, high = b[new], b[np.append(new[1:], len(b)) - 1]
            owner = row[new]
            yield pa.RecordBatch.from_arrays(
                [table.column("key").take(pa.array(owner)).combine_chunks(), pa.array((place[owner] - high).astype(np.int32)), pa.array((place[owner] - low + span).astype(np.int32))], ["key", "start", "end"]
            )


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column("text"))
        kept, removed, spans = [], [], []
        for k, found in enumerate(batch.column("spans").to_pylist()):
            raw, n = data[offsets[k] : offsets[k + 1]], 0
            if found:
                edge = np.zeros(len(raw) + 1, np.int32)
                np.add.at(edge, [x["start"] for x in found], 1)
                np.add.at(edge, [x["end"] for x in found], -1)
                gone = np.cumsum(edge)[:-1] > 0
                n = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                raw = raw[~gone]
            kept.append(raw.tobytes())
            removed.append(int(offsets[k + 1] - offsets[k]) - len(raw))
            spans.append(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
        )


def _dealt(table: DataFrame, span: int, gram: int) -> DataFrame:
    """(key, start, end) as _decide gives them, for strings with any number of contexts: no task holds all of one."""
    before = F.shiftright("at", 12).bitwiseAND(F.lit(4095)).cast("int")
    ahead = table.select("h", "c", F.lit(0).alias("back"), F.expr("substr(context, 1 + int(shiftright(at, 12) & 4095))").alias("suffix"))
    behind = table.select("h", "c", F.lit(1).alias("back"), F.substring("context", F.lit(1), before + F.lit(gram)).alias("suffix"))
    behind = behind.withColumn("suffix", F.unhex(F.array_join(F.reverse(F.expr("transform(sequence(1, length(suffix)), i -> hex(substr(suffix, i, 1)))")), "")))
    suffixes = ahead.union(behind).withColumn("lead", F.expr("rpad(substr(suffix, 1, 8), 8, X'00')"))
    # The context's hash as last key lets a splitter fall between equal suffixes, of which a common passage makes many.
    buckets = suffixes.repartitionByRange("back", "lead", "suffix", "c").sortWithinPartitions("back", "lead")
    width = -(-span // 8) * 8
    reaches = cut(buckets.mapInArrow(lambda it: _neighbours(it, width), "h long, c long, back int, reach long, part long, suffix binary"))
    # Across partitions: the last suffix of one and the first of the next, two rows for a Spark partition, whatever it holds.
    edges = sorted(reaches.where("suffix IS NOT NULL").collect(), key=lambda r: (r["part"], r["back"], bytes(r["suffix"])[:width]))
    more = []
    for x, y in zip(edges, edges[1:], strict=False):
        if x["back"] == y["back"] and x["part"] != y["part"]:
            same = common(bytes(x["suffix"]), bytes(y["suffix"]), width)
            more += [(r["h"], r["c"], r["back"], same) for r in (x, y)]
    reaches = reaches.select("h", "c", "back", "reach").union(table.sparkSession.createDataFrame(more, "h long, c long, back int, reach long"))
    reach = reaches.groupBy("h", "c").agg(F.max(F.when(F.col("back") == 0, F.col("reach"))).alias("ahead"), F.max(F.when(F.col("back") == 1, F.col("reach"))).alias("behind"))
    open_ = reach.where((F.col("ahead") >= gram) & (F.col("behind") >= gram) & (F.col("ahead") + F.col("behind") >= span + gram))
    windows = cut(split_join(table, open_, ["h", "c"]).mapInArrow(lambda it: _windows(it, span, gram), "w binary, id long, key binary, start long"))
    twice = windows.groupBy("w").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x <> y").select("w")
    return split_join(windows.where("key IS NOT NULL"), twice, ["w"]).select("key", F.col("start").cast("int").alias("start"), (F.col("start") + span).cast("int").alias("end"))


def repeated_spans(keyed: DataFrame, span: int = SPAN, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(key, start, end): spans of the texts (doc_id, key, text) whose bytes are covered by repeated strings; they overlap."""
    places = keyed.select("key", "text").mapInArrow(lambda it: _places(it, span, gram), "h long, c long, key binary, at long")
    classes = places.groupBy("h").agg(F.count("*").alias("n"), (F.min("c") != F.max("c")).alias("mixed")).where("n > 1").drop("n")
    again = stored(split_join(places, classes, ["h"]).groupBy("h", "c", "mixed", "key", "at").agg(F.count("*").alias("n")))
    # A context in a mixed class: its occurrences, and one of them to read it from.
    mixed = again.where("mixed").drop("mixed")
    contexts = mixed.groupBy("h", "c").agg(F.sum("n").alias("n"), F.min(F.struct("key", "at")).alias("one"))
    full = again.where("NOT mixed").select("key", "at").union(split_join(mixed.drop("n"), contexts.where("n > 1").select("h", "c"), ["h", "c"]).select("key", "at"))
    wanted = contexts.select(F.col("one.key").alias("key"), F.struct("h", "c", F.col("one.at").alias("at"), "n").alias("x"))
    wanted = wanted.groupBy("key").agg(F.collect_list("x").alias("wanted"))
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("rep"))
    read = wanted.join(first, "key").withColumnRenamed("key", "_key")
    read = keyed.join(read, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("key", "text", "wanted")
    table = stored(read.mapInArrow(lambda it: _contexts(it, span), "h long, c long, key binary, at long, n long, context binary"))

    lead = F.substr("context", (F.lit(1) + F.shiftright("at", 12).bitwiseAND(F.lit(4095))).cast("int"), F.lit(gram))
    crowded = table.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("h")
    hits = table.join(small_side(crowded), "h", "left_anti").withColumn("lead", lead)
    hits = hits.repartitionByRange("lead").sortWithinPartitions("lead").select("h", "key", "at", "n", "context").mapInArrow(lambda it: _decide(it, span, gram), "key binary, start int, end int")
    if not crowded.isEmpty():
        hits = hits.union(_dealt(split_join(table, crowded, ["h"]), span, gram))
    place, low, high = F.shiftright("at", 24), F.shiftright("at", 12).bitwiseAND(F.lit(4095)), F.col("at").bitwiseAND(F.lit(4095))
    full = full.select("key", (place - low).cast("int").alias("start"), (place - low + high + span).cast("int").alias("end"))
    return full.union(hits)


def strip_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256: a row for each row of ``docs``.

    Every byte that a repeated string of ``span`` bytes covers goes, in all its places; overlaps within a text count. Null
    text is the empty one; texts shorter than ``span`` stay; rows that repeat are documents of their own, and so lose their
    whole text. Only doc_id and text are read.
    """
    keyed = docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
    spans = repeated_spans(keyed, span, gram, crowd).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    both = split_join(keyed, stored(spans), ["key"], "left").select("doc_id", "text", "spans")
    return both.mapInArrow(_strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string").withColumnRenamed("doc_id", doc_id)
