"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

Index: postings (term, document, position) of the terms that the search reads. Search: each window of an item (ten words
in a row, or all of a shorter item) takes its two rarest terms by their counts over the whole corpus. Their posting lists,
shifted by the terms' offsets in the item, meet where both terms stand as far apart as in the item: (document, item,
start). Only these places are compared word by word, which gives the exact phrases.

Proximity: a window that stands in a text with up to a fifth of its words substituted, inserted or deleted. What is left of
it holds a seed, some words in a row; from each seed that an item and a text share, the window is compared by edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch.llm.common import cut, small_side, split_join, text_key, where_computed

WINDOW = 10
#: Posting lists that a window intersects before words are compared.
RAREST = 2
#: Share of a window's words that may not be edited in a proximity match.
NEAR = 0.8

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of ASCII letters, digits and non-ASCII characters. Null has none."""
    return F.transform(_raw_words(text), _ascii_lower)


def _raw_words(text: Column) -> Column:
    """Words in their own case."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")


def _ascii_lower(word: Column) -> Column:
    """lower() where it changes ASCII letters only; translate, much slower, for a word with other capitals."""
    plain = (F.octet_length(word) == F.length(word)) | ~F.regexp_like(word, F.lit(r"[\p{IsUppercase}\p{IsTitlecase}&&[^A-Z]]"))
    return F.when(plain, F.lower(word)).otherwise(F.translate(word, _UPPER, _UPPER.lower()))


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, terms, code) of the items with a word; code, a 64-bit hash of both, stands for them in the search.

    Items that repeat are one; an id with several texts has each of them.
    """
    found = items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("terms")).where("size(terms) > 0").distinct()
    return found.withColumn("code", F.xxhash64("item", "terms"))


def postings(docs: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """(term, key, pos) for the given ``terms`` (term): the inverted index, keyed by content."""
    rows = docs.select(text_key(F.col(text)).alias("key"), F.posexplode(_raw_words(F.col(text))).alias("pos", "word"))
    return rows.select("key", "pos", _ascii_lower(F.col("word")).alias("term")).join(terms, "term", "left_semi")


def anchors(items: DataFrame, counts: DataFrame, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """(code, need, term, off): the places of an item that are among the rarest terms of a window; a window has ``need`` of them.

    A window with a term that the corpus lacks cannot occur and has none. A window of one word needs one place, others two.
    """
    spans = items.select("code", "terms", F.expr(f"explode(sequence(0, greatest(size(terms) - {window}, 0)))").alias("w"))
    spans = spans.select("code", "terms", "w", F.expr(f"explode(sequence(w, w + least({window}, size(terms)) - 1))").alias("off"))
    spans = spans.select("code", F.least(F.lit(rarest), F.size("terms")).alias("need"), "w", "off", F.col("terms")[F.col("off")].alias("term")).join(counts, "term", "left")
    by_window = Window.partitionBy("code", "w")
    ranked = spans.withColumn("known", F.count("n").over(by_window) == F.count("*").over(by_window)).withColumn("rank", F.row_number().over(by_window.orderBy("n", "off")))
    return ranked.where(F.col("known") & (F.col("rank") <= rarest)).select("code", "need", "term", "off").distinct()


def places(docs: DataFrame, items: DataFrame, text: str, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """(key, item, terms, start): where enough of an item's anchors stand at their offsets; start may be negative."""
    vocabulary = small_side(items.select(F.explode("terms").alias("term")).distinct())
    counts = postings(docs, text, vocabulary).groupBy("term").agg(F.count("*").alias("n"))
    marks = cut(anchors(items, counts, window, rarest))
    index = postings(docs, text, small_side(marks.select("term").distinct())).distinct()
    # Postings are distinct, so a place of an item counts once at a start.
    met = index.join(small_side(marks), "term").groupBy("key", "code", "need", (F.col("pos") - F.col("off")).alias("start")).agg(F.count("*").alias("met"))
    return met.where("met >= need").join(small_side(items), "code").select("key", "item", "terms", "start")


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """_row (a struct of all columns of ``docs``), n_words and hits (item, exact positions), a row for each document.

    hits: items with a window that occurs whole, and the positions of the words inside its occurrences. Null or empty texts
    have no words; no items give no hits; repeated rows get a row each; documents with equal text share one search.
    """
    terms = item_terms(items, item_id, item_text)
    found = places(docs, terms, text, window).groupBy("key").agg(F.collect_list(F.struct("item", "terms", "start")).alias("places"))
    rows = docs.select(text_key(F.col(text)).alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    rows = split_join(rows, found, ["key"], "left").withColumn("raw", _raw_words(F.col("_row").getField(text)))
    rows = rows.select("_row", F.size("raw").cast("long").alias("n_words"), F.when(F.col("places").isNotNull(), F.transform("raw", _ascii_lower)).alias("words"), "places")
    same = "transform(p.terms, (t, o) -> p.start + o >= 0 AND p.start + o < size(words) AND coalesce(get(words, p.start + o) = t, false))"
    rows = rows.withColumn("same", F.expr(f"transform(places, p -> named_struct('item', p.item, 'start', p.start, 'w', least({window}, size(p.terms)), 'eq', {same}))"))
    runs = "filter(sequence(0, size(s.eq) - s.w), i -> forall(slice(s.eq, i + 1, s.w), x -> x))"
    hits = f"filter(transform(same, s -> named_struct('item', s.item, 'at', flatten(transform({runs}, i -> sequence(s.start + i, s.start + i + s.w - 1))))), h -> size(h.at) > 0)"
    return rows.select("_row", "n_words", F.expr(f"coalesce({hits}, array())").alias("hits"))


def _seed_words(size: int, edits: int) -> int:
    """Words in a row that stay somewhere in a window of ``size`` words whatever ``edits`` words are edited."""
    return -(-(size - edits) // (edits + 1))


def _grams(words: str, n: int) -> str:
    """(at, gram) of the runs of n words, as SQL."""
    one = ", ".join(f"{words}[i + {k}]" for k in range(n))
    return f"transform(filter(sequence(0, size({words}) - {n}), i -> i >= 0 AND i + {n} <= size({words})), i -> struct(int(i) AS at, xxhash64({one}) AS gram))"


def near_passages(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, near: float = NEAR) -> DataFrame:
    """(key, near_items): per text the items with a window that stands there after at most (1 - ``near``) of its words are edited.

    An edit substitutes, inserts or deletes a word; unedited windows count too. Windows are as in contaminated(); the text
    may hold words the item lacks and the other way round. Texts without such an item are left out.
    """
    terms = item_terms(items, item_id, item_text).withColumn("w", F.expr(f"least({window}, size(terms))"))
    sizes = sorted(r["w"] for r in terms.select("w").distinct().collect())  # ``window`` numbers at most
    keyed = docs.select(text_key(F.col(text)).alias("key"), words(F.col(text)).alias("words"))
    found = []
    by_seed: dict[int, list[int]] = {}
    for w in sizes:
        by_seed.setdefault(min(_seed_words(w, int(w * (1 - near) + 1e-9)), 3), []).append(w)
    for n, group in by_seed.items():
        # off: the seed's place in the item; here: item words around it, ``window`` - n on each side at most.
        marks = terms.where(F.col("w").isin(group)).select("item", "terms", "w", F.expr(f"inline({_grams('terms', n)})")).withColumnRenamed("at", "off")
        marks = marks.select("gram", "item", "w", F.expr(f"slice(terms, greatest(off - {window - n}, 0) + 1, least(off, {window - n}))").alias("before"), F.expr(f"slice(terms, off + {n + 1}, {window - n})").alias("after")).distinct()
        grams = small_side(marks.select("gram").distinct())
        seeds = keyed.select("key", F.expr(f"inline({_grams('words', n)})")).join(grams, "gram", "left_semi").distinct()
        here = seeds.groupBy("key").agg(F.collect_list(F.struct("at", "gram")).alias("seeds"))
        # A text's words around its seeds, with as many more as may be inserted.
        wide = window - n + int(window * (1 - near) + 1e-9)
        around = f"transform(seeds, s -> struct(s.gram AS gram, slice(words, greatest(s.at - {wide}, 0) + 1, least(s.at, {wide})) AS left, slice(words, s.at + {n + 1}, {wide}) AS right))"
        rows = split_join(keyed.dropDuplicates(["key"]), here, ["key"]).select("key", F.expr(f"inline({around})")).distinct()
        met = rows.join(small_side(marks), "gram")
        found.append(where_computed(met.withColumn("edits", _edits(n, window, wide - window + n)), F.expr(f"edits <= floor(w * {1 - near!r}D + 1e-9D)")).select("key", "item"))
    if not found:
        return keyed.select("key", F.lit("").alias("near_items")).limit(0)
    both = found[0]
    for more in found[1:]:
        both = both.unionByName(more)
    return both.distinct().groupBy("key").agg(F.array_join(F.array_sort(F.collect_list("item")), ",").alias("near_items"))


def _edits(n: int, window: int, extra: int) -> Column:
    """Least edits of a window of w words that holds the seed: those left of it and right of it, for every place of the seed.

    Words become letters, their places in the item, so that levenshtein counts words.
    """
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    if 2 * (window - n) > len(letters):
        raise ValueError(f"a window of {window} words has more places than letters")
    code = lambda side: f"concat_ws('', transform({side}, x -> if(array_position(own, x) > 0, substr('{letters}', int(array_position(own, x)), 1), '-')))"
    tail, head = "right({0}, {1})", "left({0}, {1})"

    def costs(part: str, mine: str, theirs: str) -> str:
        """Array: the least edits of the k words next to the seed, for k from 0; null beyond the item's end."""
        out = []
        for k in range(window - n + 1):
            tries = ", ".join(f"levenshtein({part.format(mine, k)}, {part.format(theirs, k + e)})" for e in range(-extra, extra + 1) if k + e >= 0)
            out.append(f"if(length({mine}) >= {k}, array_min(array({tries})), null)")
        return f"array({', '.join(out)})"

    both = f"transform(sequence(0, w - {n}), k -> coalesce(x.l[k] + x.r[w - {n} - k], 999))"
    named = f"struct({code('before')} AS bi, {code('after')} AS ai, {code('left')} AS bt, {code('right')} AS at)"
    # Each step names its results once, by a transform over an array of one.
    sql = f"transform(transform(transform(array(concat(before, after)), own -> {named}), c -> struct({costs(tail, 'c.bi', 'c.bt')} AS l, {costs(head, 'c.ai', 'c.at')} AS r)), x -> array_min({both}))[0]"
    return F.expr(sql)


def report(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", near: float | None = NEAR, **names) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, near_items for each document; without ``near`` no near_items."""
    df = contaminated(docs.select(doc_id, text), items, text, **names).withColumn("ids", F.expr("array_sort(array_distinct(transform(hits, h -> h.item)))"))
    more = []
    if near is not None:
        passages = near_passages(docs, items, text, near=near, **names)
        df = split_join(df.withColumn("key", text_key(F.col("_row").getField(text))), passages, ["key"], "left")
        more = [F.coalesce("near_items", F.lit("")).alias("near_items")]
    return df.select(
        F.col("_row").getField(doc_id).alias(doc_id),
        "n_words",
        F.expr("bigint(size(array_distinct(flatten(transform(hits, h -> h.at)))))").alias("n_hit"),
        F.expr("bigint(size(ids))").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        F.expr("size(hits) > 0").alias("contaminated"),
        *more,
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` that hold no whole window of an item, with all their columns."""
    return where_computed(contaminated(docs, items, text, **names), "size(hits) = 0").select("_row.*")
