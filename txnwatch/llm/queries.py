"""One query for each training-data operator, over its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.llm import chunk_dedup, decontamination, filter_audit, hard_negatives, language_id, line_dedup, mixing, ngram_join, pii, quality_model, quality_rules, suffix_dedup, top_k
from txnwatch.llm.common import documents


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similarity_join(documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(documents(spark, sf_dir))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), near=None)


def op3_near_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op4_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.strip_repeats(documents(spark, sf_dir)).drop("kept")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.strip_repeated(documents(spark, sf_dir)).drop("kept")


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir)).drop("n_grams")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", "text")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("key")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_ngram_join, op2_quality_rules, op3_decontamination, op4_chunk_dedup, op5_suffix_dedup,
        op6_quality_model, op7_language_id, op8_line_dedup, op9_personal_data, op10_mixing, op3_near_passages, op11_hard_negatives, op12_filter_audit, op13_top_k,
    )
    return {f.__name__: f for f in ops}


def _quality_sql() -> str:
    tests = quality_rules.compile_rules(quality_rules.RULES)
    stop = ", ".join("'" + f + "'" for f in sorted({f for x in quality_rules.STOP_WORDS for f in (x, x.capitalize())}))
    failed = ", ".join(f"CASE WHEN NOT ({t}) THEN '{n}' END" for n, t in tests.items())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
u AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT doc_id, i, a, lead(a, 1) OVER p AS b, lead(a, 2) OVER p AS c FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM g WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
n AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines, len(list_filter(ws, lambda x: x IN ({stop}))) AS n_stop,
             length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper, length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS n_letters,
             len(list_filter(ls, lambda x: rtrim(x) LIKE '%...' OR rtrim(x) LIKE '%…')) AS n_ellipsis,
             len(list_filter(ls, lambda x: regexp_matches(ltrim(x), '^[-•*] '))) AS n_bullets
      FROM w LEFT JOIN n USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, list_filter([{failed}], lambda x: x IS NOT NULL) AS fs FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND len(fs) = 0 AS kept, coalesce(array_to_string(fs, ','), '') AS failed FROM f
"""


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS ws FROM benchmark),
u AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
x AS (SELECT item_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM b WHERE len(ws) >= 10),
du AS (SELECT doc_id, i, string_agg(w, ' ') OVER p AS g, count(*) OVER p AS n FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
xu AS (SELECT item_id, string_agg(w, ' ') OVER p AS g, count(*) OVER p AS n FROM x WINDOW p AS (PARTITION BY item_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)),
hits AS (
  SELECT du.doc_id, xu.item_id, du.i, 10 AS size FROM du JOIN (SELECT DISTINCT item_id, g FROM xu WHERE n = 10) xu USING (g) WHERE du.n = 10
  UNION ALL
  SELECT u.doc_id, s.item_id, u.i, len(s.ws) FROM u JOIN (SELECT * FROM b WHERE len(ws) BETWEEN 1 AND 9) s ON u.w = s.ws[1] JOIN d USING (doc_id)
  WHERE array_slice(d.ws, u.i, u.i + len(s.ws) - 1) = s.ws),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_LINES_SQL = rf"""
WITH l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
p AS (SELECT source, count(DISTINCT text) AS pages FROM documents GROUP BY source),
f AS (SELECT source, trim(line) AS line, count(DISTINCT text) AS n FROM l WHERE regexp_matches(line, '\S') GROUP BY ALL),
b AS (SELECT source, line FROM f JOIN p USING (source) WHERE n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.MAX_RATIO} * pages),
k AS (SELECT l.*, b.line IS NOT NULL AS gone FROM l LEFT JOIN b ON l.source = b.source AND trim(l.line) = b.line)
SELECT doc_id, count(*) FILTER (WHERE regexp_matches(line, '\S')) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
FROM k GROUP BY doc_id
"""

_JOIN_SQL = rf"""
WITH RECURSIVE t AS (SELECT coalesce(text, '') AS text, min(doc_id) AS class_id, count(*) AS n_copies FROM documents GROUP BY 1),
w AS (SELECT class_id, n_copies, {_WORDS_SQL} AS ws FROM t),
u AS (SELECT class_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM w),
s AS (SELECT class_id, i, string_agg(a, ' ') OVER p AS g, count(*) OVER p AS m, n FROM u WINDOW p AS (PARTITION BY class_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
g AS (SELECT class_id, g FROM s WHERE m = 5 OR (n < 5 AND i = 1)),
e AS (SELECT DISTINCT class_id, g FROM g),
z AS (SELECT class_id, count(*) AS size FROM e GROUP BY 1),
o AS (SELECT x.class_id AS a, y.class_id AS b, count(*) AS met FROM e x JOIN e y USING (g) WHERE x.class_id <> y.class_id GROUP BY ALL),
k AS (SELECT a, b FROM o JOIN z x ON a = x.class_id JOIN z y ON b = y.class_id WHERE met >= 0.8 * (x.size + y.size - met)),
c(a, b) AS (SELECT class_id, class_id FROM t UNION SELECT c.a, k.b FROM c JOIN k ON c.b = k.a),
r AS (SELECT a AS class_id, min(b) AS group_id FROM c GROUP BY 1),
l AS (SELECT a AS class_id, count(*) AS n_links FROM k GROUP BY 1),
n AS (SELECT class_id, count(*) AS n_grams FROM g GROUP BY 1)
SELECT d.doc_id, class_id, n_copies, coalesce(n_links, 0) AS n_links, group_id, coalesce(n_grams, 0) AS n_grams
FROM documents d JOIN t ON coalesce(d.text, '') = t.text JOIN r USING (class_id) LEFT JOIN l USING (class_id) LEFT JOIN n USING (class_id)
"""


#: Integer vectors of the rows that take part.
_VECTORS_SQL = """
i AS (SELECT vec_id, {label} AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND {label} IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
"""

_TOP_K_SQL = f"""
WITH {_VECTORS_SQL.format(label="0")},
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM i q JOIN i c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 5
"""

_LABEL_SQL = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"

_NEGATIVES_SQL = f"""
WITH {_VECTORS_SQL.format(label=_LABEL_SQL)},
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
      FROM i a JOIN i c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score QUALIFY rank <= 5
"""

_AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, part, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
f AS (SELECT doc_id, part, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b, 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
x AS (SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS z, generate_subscripts(['A', 'B', 'C', 'D', 'E'], 1) AS i),
o AS (SELECT concat(p.z, q.z, r.z, s.z, u.z) AS filter_order, [p.i, q.i, r.i, s.i, u.i] AS seq
      FROM letters p, letters q, letters r, letters s, letters u WHERE len(list_distinct([p.i, q.i, r.i, s.i, u.i])) = 5),
k AS (SELECT part, filter_order, unnest([1, 2, 3, 4, 5]) AS step, seq, fails, n, good, toxic FROM x, o),
y AS (SELECT part, filter_order, step, seq[step] AS own, fails[seq[step]] AS hit, len(list_filter(seq[1:step - 1], lambda i: fails[i])) > 0 AS gone,
             len(list_filter(fails, lambda z: z)) AS n_fails, n, good, toxic FROM k),
v AS (SELECT part, filter_order, step, any_value(own) AS own, coalesce(sum(n) FILTER (WHERE NOT hit AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0) AS removed,
             coalesce(sum(n) FILTER (WHERE hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (WHERE hit AND n_fails = 1), 0) AS unique_fails,
             coalesce(sum(good) FILTER (WHERE hit AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE hit AND NOT gone), 0) AS toxic_lost
      FROM y GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM v
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": _JOIN_SQL, "op2_quality_rules": _quality_sql(), "op3_decontamination": _DECONTAMINATION_SQL, "op8_line_dedup": _LINES_SQL,
        "op11_hard_negatives": _NEGATIVES_SQL, "op12_filter_audit": _AUDIT_SQL, "op13_top_k": _TOP_K_SQL,
    }
