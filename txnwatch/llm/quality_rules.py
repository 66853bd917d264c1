"""Quality rules: a threshold table compiled into one projection, no user functions, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnwatch.llm.common import where_computed

#: Frequent short words of the languages served (fixed values).
STOP_WORDS = (
    "the of and to in is that it for was on with as by this be from or are an "
    "der die und in zu den das nicht von mit ist des ein eine auf für im dem "
    "de la le et les des que en un une du est pour dans qui par sur au "
    "el los las y del se con por para su no como más es lo al"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= measure <= high (a bound of None is open) or the measure is null."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Measures: SQL over the counted columns. Null where the denominator is zero.
MEASURES = {
    "words": "n_words",
    "mean_word_chars": "word_chars / nullif(n_words, 0)",
    "symbols_per_word": "n_symbols / nullif(n_words, 0)",
    "stop_word_share": "n_stop / nullif(n_words, 0)",
    "letter_share": "n_letters / nullif(word_chars, 0)",
    "upper_share": "n_upper / nullif(n_letters, 0)",
    "repeated_word_share": "n_repeat_words / nullif(n_words, 0)",
    "repeated_line_share": "n_dup_lines / nullif(n_lines, 0)",
    "ellipsis_line_share": "n_ellipsis / nullif(n_lines, 0)",
    "bullet_line_share": "n_bullets / nullif(n_lines, 0)",
}

RULES = (
    Rule("length", "words", low=50),
    Rule("word_length", "mean_word_chars", low=3, high=12),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("stop_words", "stop_word_share", low=0.05),
    Rule("letters", "letter_share", low=0.7),
    Rule("shouting", "upper_share", high=0.4),
    Rule("repetition", "repeated_word_share", high=0.4),
    Rule("repeated_lines", "repeated_line_share", high=0.6),
    Rule("ellipses", "ellipsis_line_share", high=0.3),
    Rule("bullets", "bullet_line_share", high=0.9),
)

#: Bits of a packed window that hold its position; a text of more words takes the pair form.
_AT_BITS = 24

_OUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def compile_rules(rules: Sequence[Rule]) -> dict[str, str]:
    """Each rule as a SQL condition that holds if the document passes; it reads the same in Spark and in ANSI engines."""
    out = {}
    for r in rules:
        m = f"CAST({MEASURES[r.measure]} AS double)"
        bounds = [f"{m} >= {r.low!r}"] * (r.low is not None) + [f"{m} <= {r.high!r}"] * (r.high is not None)
        out[r.name] = f"coalesce({' AND '.join(bounds) or 'true'}, true)"
    return out


def _covered(at: str) -> str:
    """Words in the union of three-word windows that start at the ascending positions ``at``."""
    return f"aggregate({at}, named_struct('n', 0L, 'end', -1L), (a, p) -> named_struct('n', a.n + p + 3 - greatest(a.end, p), 'end', p + 3), a -> a.n)"


def measure(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the base counts and the helpers that MEASURES names, from whole texts.

    Null text has no words and no lines. Windows of three words are compared by 64-bit hashes, sorted in the row;
    the cost is n log n in the words of a text, and nothing leaves the row.
    """
    spaces = "[ \\t\\n\\u000b\\f\\r]+"
    df = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    df = df.withColumn("_words", F.array_remove(F.split("_t", spaces), "")).withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    df = df.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))
    window = "xxhash64({0}, _h[{1} + 1], _h[{1} + 2])"
    starts = "slice(_h, 1, greatest(size(_h) - 2, 0))"
    low = (1 << _AT_BITS) - 1
    # The packed form sorts plain longs, the top 40 bits of the hash and then the position; candidates get the whole hash below.
    df = df.withColumn("_s", F.expr(f"CASE WHEN size(_h) <= {low} THEN sort_array(transform({starts}, (h, i) -> ({window.format('h', 'i')} & {~low}L) + i)) ELSE array() END"))
    df = df.withColumn("_near", F.expr(f"filter(_s, (x, i) -> shiftright(x ^ get(_s, i - 1), {_AT_BITS}) = 0 OR shiftright(x ^ get(_s, i + 1), {_AT_BITS}) = 0)"))
    at = f"int(x & {low})"
    packed = f"sort_array(transform(_near, x -> named_struct('h', {window.format(f'_h[{at}]', at)}, 'p', x & {low})))"
    pairs = f"sort_array(transform({starts}, (h, i) -> named_struct('h', {window.format('h', 'i')}, 'p', bigint(i))))"
    df = df.withColumn("_c", F.expr(f"CASE WHEN size(_h) <= {low} THEN {packed} ELSE {pairs} END"))
    df = df.withColumn("_dup", F.expr("array_sort(transform(filter(_c, (x, i) -> (i > 0 AND x.h = _c[i - 1].h) OR (i + 1 < size(_c) AND x.h = _c[i + 1].h)), x -> x.p))"))
    counts = {
        "n_words": "bigint(size(_words))",
        "word_chars": "aggregate(_words, 0L, (a, w) -> a + length(w))",
        "n_symbols": F.length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": "bigint(size(_lines) - size(array_distinct(_lines)))",
        "n_repeat_words": _covered("_dup"),
        "n_lines": "bigint(size(_lines))",
        "n_stop": F.size(F.filter("_words", lambda w: w.isin(sorted({f for x in STOP_WORDS for f in (x, x.capitalize())})))).cast("long"),
        "n_upper": F.length(F.regexp_replace("_t", "[^\\p{Lu}]+", "")).cast("long"),
        "n_letters": F.length(F.regexp_replace("_t", "[^\\p{L}]+", "")).cast("long"),
        "n_ellipsis": F.size(F.filter("_lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long"),
        "n_bullets": F.size(F.filter("_lines", lambda x: F.ltrim(x).rlike("^[-•*] "))).cast("long"),
    }
    return df.select(*keep, *((F.expr(c) if isinstance(c, str) else c).alias(name) for name, c in counts.items()))


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, base counts, base_failed, kept and ``failed`` (names of the rules that reject), a row for each document.

    base_failed: fewer than 50 words, or over half of them in repeated three-word windows. An empty or null text has zero
    counts and is rejected by its length; a null doc_id is kept; repeated rows get a row each; other columns are ignored.
    """
    tests = compile_rules(rules)
    df = measure(docs, text, keep)
    df = df.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
    df = df.withColumn("failed", F.expr("filter(array(" + ", ".join(f"CASE WHEN NOT ({t}) THEN '{n}' END" for n, t in tests.items()) + "), x -> x IS NOT NULL)") if tests else F.expr("cast(array() AS array<string>)"))
    return df.select(*keep, *_OUT, "base_failed", F.expr("NOT base_failed AND size(failed) = 0").alias("kept"), F.concat_ws(",", "failed").alias("failed"))


def filter_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, in one pass without a join."""
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(text).alias("_text"))
    return where_computed(apply_rules(whole, rules, "_text", ("_row",)), "kept").select("_row.*")
