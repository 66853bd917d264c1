"""Language identification by language-bitmask n-gram filters.

Each language has a Bloom filter of its frequent letter n-grams. The filters are stored bit-sliced: a slot is one integer
whose bit l belongs to language l, so that a look-up of an n-gram, the AND of its slots, gives all languages that contain
it at once. A text's n-grams give a count for each language (popcounts of its bit), from which the expected false positives
of that filter are taken; the largest corrected count decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import blocks, buffers, constants, mix

#: Bytes of an n-gram, slots of a filter, hashes of an n-gram.
GRAM = 4
SLOTS = 1 << 18
HASHES = 4
#: An n-gram belongs to a language from this share of its n-grams on: at most 1 / LEAST of them a language.
LEAST = 1e-4
UNKNOWN = "und"

#: ASCII letters lower-cased and non-ASCII bytes as they are; all else separates words.
_LETTERS = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint32)


def held_out(doc_id: Column) -> Column:
    """The documents that nothing is learned from: crc32 of the id as text, modulo 4, is 2. A null id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as 32-bit numbers, document of each): those with three letters or more and no space inside."""
    low = _LETTERS[data]
    if len(low) < GRAM:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    n = len(low) - GRAM + 1
    gram = (low[:n] << np.uint32(24)) | (low[1 : n + 1] << np.uint32(16)) | (low[2 : n + 2] << np.uint32(8)) | low[3 : n + 3]
    ok = (low[1 : n + 1] != 32) & (low[2 : n + 2] != 32) & ((low[:n] != 32) | (low[3 : n + 3] != 32))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ok &= owner[:n] == owner[GRAM - 1 :]
    return gram[ok], owner[:n][ok]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of each block of texts."""
    for b in batches:
        data, offsets = buffers(b.column("text"))
        names, code = np.unique(np.array(b.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        for i, j in blocks(offsets, 1 << 22):
            gram, owner = _grams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            both, n = np.unique((code[i:j][owner].astype(np.uint64) << np.uint64(32)) | gram, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[(both >> np.uint64(32)).astype(np.int64)], pa.string()), pa.array((both & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
            )


def _slots(gram: np.ndarray) -> np.ndarray:
    """HASHES slots of each n-gram."""
    x = mix(gram.astype(np.uint64) * np.uint64(2) + np.uint64(1))
    with np.errstate(over="ignore"):
        return np.stack([(x * c) >> np.uint64(64 - SLOTS.bit_length() + 1) for c in constants(HASHES, 9)]).astype(np.int64)


class Filters:
    """Bit-sliced Bloom filters of the languages; 63 languages share a word of a slot."""

    def __init__(self, grams: dict[str, np.ndarray]):
        self.languages = sorted(grams)
        self.slices = np.zeros((max(1, -(-len(self.languages) // 63)), SLOTS), np.int64)
        for k, name in enumerate(self.languages):
            self.slices[k // 63, _slots(grams[name]).ravel()] |= np.int64(1 << (k % 63))
        self.false_rate = np.array([((self.slices[k // 63] >> (k % 63)) & 1).mean() ** HASHES for k in range(len(self.languages))])

    def counts(self, gram: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents x languages: corrected counts, n-grams of each document)."""
        total = np.bincount(owner, minlength=n)
        out = np.zeros((n, len(self.languages)))
        at = _slots(gram)
        for s, row in enumerate(self.slices):
            mask = np.bitwise_and.reduce(row[at], axis=0)
            for k in range(s * 63, min((s + 1) * 63, len(self.languages))):
                out[:, k] = np.bincount(owner[(mask >> (k % 63)) & 1 == 1], minlength=n)
        return np.maximum(out - total[:, None] * self.false_rate, 0) / (1 - self.false_rate), total


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", least: float = LEAST) -> Filters:
    """Filters from all texts with a language that aren't held out; at most 1 / least n-grams a language reach the driver."""
    rows = docs.where(~held_out(F.col(doc_id)) & F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.lower(F.col(text)).alias("text"))
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).withColumnRenamed("lang", "_lang")
    kept = counts.join(totals, F.col("lang") == F.col("_lang")).where(F.col("n") >= least * F.col("total")).select("lang", "gram").collect()
    grams: dict[str, list[int]] = {r["lang"]: [] for r in rows.select("lang").distinct().collect()}
    for r in kept:
        grams[r["lang"]].append(r["gram"])
    return Filters({k: np.array(v, np.uint32) for k, v in grams.items()})


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", least: float = LEAST) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_grams: a row for each row of ``docs``.

    score: the share of the text's n-grams that the language's filter holds, corrected. A text that is null or has no
    letter, and any text if no language could be learned, is ``und`` with score 0. Ties, and texts without any n-gram, go to
    the first language in alphabetical order. Repeated rows get a row each; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, doc_id, text, lang, least))  # SLOTS numbers for each 63 languages

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        names = np.array([*filters.languages, UNKNOWN], object)
        for b in batches:
            data, offsets = buffers(b.column("text"))
            best, score, total = [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]
            for i, j in blocks(offsets):
                counts, n = filters.counts(*_grams(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), j - i)
                if counts.shape[1]:
                    best.append(counts.argmax(axis=1))
                    score.append(np.clip(counts.max(axis=1) / np.maximum(n, 1), 0, 1))
                else:
                    best.append(np.full(j - i, -1))
                    score.append(np.zeros(j - i))
                total.append(n)
            letters = np.array(b.column("letters"), bool)
            best = np.where(letters, np.concatenate(best), -1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(names[best].tolist(), pa.string()), pa.array(np.where(best >= 0, np.concatenate(score), 0.0)), pa.array(np.concatenate(total).astype(np.int64))],
                ["doc_id", "held_out", "lang_pred", "score", "n_grams"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.coalesce(F.regexp_like(text, F.lit("\\p{L}")), F.lit(False)).alias("letters"), F.lower(F.col(text)).alias("text"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, n_grams long").withColumnRenamed("doc_id", doc_id)
