"""Personal data: high-recall generators propose spans, boosted trees over their format and context score them, and a
calibrated threshold selects redactions beside the spans of the fixed base formats. DataFrame operations only."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# Possessive forms of the base formats: the same matches without deep recursion. The look-behinds only skip starts inside a
# run whose first character has failed already; \G lets a match start where the last one ended.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: What may be personal data, at high recall and of any length; the proposals overlap each other and the base formats. A pattern
#: takes a whole run, whatever becomes of it, so that no start inside a run is tried again; the condition on the match, its
#: digits and the character behind it then decides.
GENERATORS = {
    "address": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)*+", "true"),
    "number": (r"(?<![A-Za-z0-9])[+(]?[0-9](?:[\x20().-]{0,2}[0-9])*+", "x.nd >= 7 AND NOT x.a RLIKE '[A-Za-z0-9]'"),
    "token": (r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{16,}+", "x.nd > 0"),
}
#: Words before a span that name what follows; they give the weak labels, so they are no features.
CUES = r"(?i)(?:token|secret|password|passwd|api.?key|access.?key|bearer|phone|tel|mobile|call|fax|ssn|passport|iban|account|card|mail)[^\p{L}\p{N}]{0,6}$"
_BEFORE = 24

#: Format and context of a proposal as small whole numbers: name -> (values, SQL over g, s (the span), b (what is before it)).
FEATURES = {
    "generator": (len(GENERATORS), "g"),
    "digits": (7, "CASE WHEN nd = 0 THEN 0 WHEN nd < 7 THEN 1 WHEN nd < 10 THEN 2 WHEN nd < 13 THEN 3 WHEN nd < 16 THEN 4 WHEN nd < 20 THEN 5 ELSE 6 END"),
    "letters": (3, "CASE WHEN nl = 0 THEN 0 WHEN nl < 5 THEN 1 ELSE 2 END"),
    "separators": (3, "CASE WHEN length(s) = nd + nl THEN 0 WHEN length(s) - nd - nl < 3 THEN 1 ELSE 2 END"),
    "hexadecimal": (2, "CASE WHEN s RLIKE '^[0-9A-Fa-f]+$' THEN 1 ELSE 0 END"),
    "quoted": (2, "CASE WHEN right(b, 1) IN ('\"', '\\'') THEN 1 ELSE 0 END"),
    "plus": (2, "CASE WHEN s LIKE '+%' THEN 1 ELSE 0 END"),
    "at": (2, "CASE WHEN s LIKE '%@%' THEN 1 ELSE 0 END"),
    "dots": (2, "CASE WHEN s RLIKE '[.][0-9]+[.]' THEN 1 ELSE 0 END"),
}
#: Share of right proposals above the threshold that the calibration asks for.
PRECISION = 0.95
ROUNDS = 40
RATE = 0.3


@dataclass(frozen=True)
class Tree:
    """Depth two: two splits (feature, value; right if equal or greater) and the values of the four leaves."""

    first: tuple[str, int]
    second: tuple[str, int]
    leaves: tuple[float, float, float, float]

    def sql(self) -> str:
        a, b = (f"f.{name} >= {value}" for name, value in (self.first, self.second))
        ll, lr, rl, rr = self.leaves
        return f"CASE WHEN {a} THEN CASE WHEN {b} THEN {rr!r}D ELSE {rl!r}D END ELSE CASE WHEN {b} THEN {lr!r}D ELSE {ll!r}D END END"

    def value(self, row: dict[str, int]) -> float:
        return self.leaves[2 * (row[self.first[0]] >= self.first[1]) + (row[self.second[0]] >= self.second[1])]


@dataclass(frozen=True)
class Model:
    """Boosted trees on log-odds; a proposal is selected if its score reaches ``threshold``."""

    start: float = 0.0
    trees: tuple[Tree, ...] = field(default=())
    threshold: float = math.inf

    def sql(self) -> str:
        return " + ".join([f"{self.start!r}D", *(f"({t.sql()})" for t in self.trees)])


#: Matches that a fold appends to one array, which each append copies; the arrays are then joined.
_FOLD = 128
#: Code points of a place in the index of a span array, and the least length of a span of any kind.
_PLACE = 64
_LEAST = 3


def _positions(text: str, pattern: str, context: bool = False) -> Column:
    """(start, end, s) of the leftmost non-overlapping matches, in code points; with ``context`` also b, what stands before the
    match (the one before it at most included), and a, the character behind it. Linear in the text."""
    names = ["s", "b", "a"] if context else ["s"]
    kind = "array<struct<start:int,end:int," + ",".join(f"{n}:string" for n in names) + ">>"
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    rest = F.when(F.size(found) > 0, F.split(F.col(text), pattern, -1))
    n = F.size(found)
    zipped = F.arrays_zip(found.alias("m"), F.slice(rest, 1, n).alias("r"), F.slice(rest, 2, n).alias("q"))

    def bound(value: Column, use) -> Column:
        """``use`` of a value that is computed once."""
        return F.transform(F.array(value), use)[0]

    def step(acc, x):
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["size"]).alias("end"), *[x[c].alias(c) for c in names])
        return F.struct((start + x["size"]).alias("at"), F.array_append(acc["out"], span).alias("out"))

    def block(items):
        def add(acc, j):
            inner = F.aggregate(F.slice(items, j * _FOLD + 1, F.lit(_FOLD)), F.struct(acc["at"].alias("at"), F.expr(f"cast(array() AS {kind})").alias("out")), step)
            return bound(inner, lambda b: F.struct(b["at"].alias("at"), F.array_append(acc["out"], b["out"]).alias("out")))
        return add

    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() AS array<{kind}>)").alias("out"))
    blocks = bound(bound(zipped, lambda z: F.transform(z, _sized(z, context))), lambda items: F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _FOLD).cast("int")), start, block(items), lambda acc: F.flatten(acc["out"])))
    return F.when(n > 0, blocks).otherwise(F.expr(f"cast(array() AS {kind})"))


def _sized(z: Column, context: bool):
    """A match of ``z`` with the lengths of itself and of the gap before it."""
    def of(x, i):
        out = [F.length(x["r"]).alias("gap"), F.length(x["m"]).alias("size"), x["m"].alias("s")]
        if context:
            before = F.concat(F.coalesce(F.get(z, i - 1)["m"], F.lit("")), x["r"])
            out += [F.right(before, F.lit(_BEFORE)).alias("b"), F.left(x["q"], F.lit(1)).alias("a")]
        return F.struct(*out)
    return of


def _index(spans: str) -> str:
    """For each place of ``_PLACE`` code points the number of the first span that ends behind its start; spans are in order and disjoint."""
    up = f"({{}} + {_PLACE - 1}) div {_PLACE}"
    return f"flatten(transform({spans}, (x, i) -> array_repeat(i, int({up.format('x.end')} - {up.format(f'coalesce(get({spans}, i - 1).end, 0)')}))))"


def _meeting(spans: str, index: str, x: str = "x") -> str:
    """The few of ``spans`` that can meet the span ``x``: as many as fit between the start of its place and its end."""
    place = f"int({x}.start div {_PLACE})"
    # The index is named twice, so that the optimizer doesn't copy what computes it into the loop; so are the spans.
    few = f"slice({spans}, get({index}, {place}) + 1, int(({x}.end - {_PLACE} * {place}) div {_LEAST}) + 2)"
    return f"CASE WHEN size({spans}) > 0 AND {place} < size({index}) THEN {few} ELSE slice({spans}, 1, 0) END"


def _digits(s: str) -> str:
    return f"regexp_replace({s}, '[^0-9]+', '')"


def _valid(kind: str) -> str:
    """Condition on a match ``x`` of a base format."""
    n = f"length({_digits('x.s')})"
    luhn = f"aggregate(transform(split(reverse({_digits('x.s')}), ''), (d, i) -> CASE WHEN i % 2 = 0 THEN int(concat('0', d)) WHEN d < '5' THEN 2 * int(concat('0', d)) ELSE 2 * int(concat('0', d)) - 9 END), 0, (a, d) -> a + d) % 10 = 0"
    part = "regexp_replace(p, '^0+', '')"
    return {
        "email": "true",
        "ip": f"forall(split(x.s, '[.]'), p -> length({part}) < 4 AND int(concat('0', {part})) <= 255)",
        "card": f"{n} BETWEEN 16 AND 19 AND {luhn}",
        "phone": f"{n} BETWEEN 8 AND 15",
    }[kind]


def base_spans(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with an array (start, end, s) for each base kind; texts without a digit or @ skip the formats."""
    may = F.regexp_like(F.col(text), F.lit("[0-9@]"))
    none = F.expr("cast(array() AS array<struct<start:int,end:int,s:string>>)")
    for kind, pattern in BASE.items():
        # An address needs an @, a phone number a +, and so on: cheap tests before the format itself.
        first = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}[kind]
        rows = rows.withColumn(f"_raw_{kind}", F.when(may & F.regexp_like(F.col(text), F.lit(first)), _positions(text, pattern)).otherwise(none))
    return rows.withColumns({f"_{kind}": F.expr(f"filter(_raw_{kind}, x -> {_valid(kind)})") for kind in KINDS}).drop(*[f"_raw_{kind}" for kind in KINDS])


def _proposals(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``_proposed``: start, end, f (features), taken (a base span overlaps), cue (a cue precedes). Either one is the
    weak label. The base arrays are in order and disjoint, so a proposal is held against the few of each at its place."""
    may = F.regexp_like(F.col(text), F.lit(r"[0-9@]|[\[(]at[\])]"))
    none = F.expr("cast(array() AS array<struct<start:int,end:int,s:string,b:string,a:string>>)")
    for g, (pattern, right) in enumerate(GENERATORS.values()):
        rows = rows.withColumn(f"_m{g}", F.when(may, _positions(text, pattern, context=True)).otherwise(none))
        counted = f"transform(_m{g}, x -> named_struct('g', {g}, 'start', x.start, 'end', x.end, 's', x.s, 'b', x.b, 'a', x.a, 'nd', length({_digits('x.s')}), 'nl', length(regexp_replace(x.s, '[^A-Za-z]+', ''))))"
        rows = rows.withColumn(f"_g{g}", F.expr(f"filter({counted}, x -> {right})"))
    gs = [f"_g{g}" for g in range(len(GENERATORS))]
    rows = rows.withColumns({f"_i_{k}": F.expr(_index(f"_{k}")) for k in KINDS}).drop(*[f"_m{g}" for g in range(len(GENERATORS))])
    rows = rows.withColumn("_found", F.concat(*gs)).drop(*gs)

    def of(sql: str) -> str:
        for name in ("g", "s", "b", "nd", "nl"):
            sql = _replace_name(sql, name)
        return sql

    features = ", ".join(f"'{name}', {of(sql)}" for name, (_, sql) in FEATURES.items())
    taken = " OR ".join(f"exists({_meeting(f'_{k}', f'_i_{k}')}, o -> o.start < x.end AND x.start < o.end)" for k in KINDS)
    rows = rows.withColumn("_proposed", F.expr(f"transform(_found, x -> named_struct('start', x.start, 'end', x.end, 'f', named_struct({features}), 'taken', {taken}, 'cue', x.b RLIKE r'{CUES}'))"))
    return rows.drop("_found", *[f"_i_{k}" for k in KINDS])


def _replace_name(sql: str, name: str) -> str:
    """``name`` as a field of x, outside string literals."""
    import re

    parts = re.split(r"('(?:[^'\\]|\\.)*')", sql)
    return "".join(p if k % 2 else re.sub(rf"(?<![\w.]){name}(?![\w(])", f"x.{name}", p) for k, p in enumerate(parts))


def boost(table: list[tuple[dict[str, int], float, float]], rounds: int = ROUNDS, rate: float = RATE, precision: float = PRECISION) -> Model:
    """Boosted trees on (features, right, wrong) counts, and the least threshold above which ``precision`` is reached.

    Every tree takes the pair of splits with the greatest gain of the logistic loss; ties go to the first in order.
    """
    right = sum(r for _, r, _ in table)
    total = sum(r + w for _, r, w in table)
    if not right or right == total:
        return Model()
    start = math.log(right / (total - right))
    score = [start] * len(table)
    splits = [(name, v) for name, (n, _) in FEATURES.items() for v in range(1, n)]
    sides = {s: [row[s[0]] >= s[1] for row, _, _ in table] for s in splits}
    trees = []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-x)) for x in score]
        grad = [r - (r + w) * q for (_, r, w), q in zip(table, p, strict=True)]
        curv = [(r + w) * q * (1 - q) for (_, r, w), q in zip(table, p, strict=True)]
        best = None
        for i, a in enumerate(splits):
            for b in splits[i:]:
                leaf = [[0.0, 0.0] for _ in range(4)]
                for k, (x, y) in enumerate(zip(sides[a], sides[b], strict=True)):
                    cell = leaf[2 * x + y]
                    cell[0] += grad[k]
                    cell[1] += curv[k]
                gain = sum(g * g / (h + 1) for g, h in leaf)
                if best is None or gain > best[0] + 1e-9:
                    best = gain, a, b, tuple(round(rate * g / (h + 1), 9) for g, h in leaf)
        trees.append(Tree(best[1], best[2], best[3]))
        score = [x + trees[-1].value(row) for x, (row, _, _) in zip(score, table, strict=True)]
    by_score: dict[float, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for x, (_, r, w) in zip(score, table, strict=True):
        by_score[round(x, 6)][0] += r
        by_score[round(x, 6)][1] += w
    threshold, r, n = math.inf, 0.0, 0.0
    for x in sorted(by_score, reverse=True):
        r, n = r + by_score[x][0], n + sum(by_score[x])
        if by_score[x][0] < precision * sum(by_score[x]) or r < precision * n:
            break
        threshold = x - 1e-5
    return Model(start, tuple(trees), threshold)


def fit(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> Model:
    """The model from the proposals in all documents; one row for each combination of features reaches the driver, whose
    number has a fixed bound, the product of the features' values times two."""
    rows = _proposals(base_spans(docs.select(F.coalesce(F.col(text), F.lit("")).alias("_t")), "_t"), "_t")
    counts = rows.select(F.explode_outer("_proposed").alias("x")).where("x IS NOT NULL").selectExpr("x.f", "x.taken OR x.cue AS y").groupBy("f", "y").count().collect()
    table: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for r in counts:
        table[tuple(r["f"])][0 if r["y"] else 1] += r["count"]
    return boost([(dict(zip(FEATURES, k, strict=True)), r, w) for k, (r, w) in sorted(table.items())], precision=precision)


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``_row`` (a struct of all columns), an array (start, end, s) for each base kind, ``added`` (start, end): spans that the
    model selects. An added span overlaps no base span, and no added one with a greater score, then length, then earlier.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = _proposals(base_spans(rows, "_t"), "_t")
    if not math.isfinite(model.threshold):
        chosen = "cast(array() AS array<struct<start:int,end:int>>)"
        return rows.select("_row", "_t", *[F.col(f"_{k}").alias(k) for k in KINDS], F.expr(chosen).alias("added"))
    score = model.sql().replace("f.", "x.f.")
    scored = f"filter(transform(filter(_proposed, x -> NOT x.taken), x -> named_struct('g', x.f.generator, 'score', {score}, 'start', x.start, 'end', x.end)), x -> x.score >= {model.threshold!r}D)"
    rows = rows.withColumn("_sel", F.expr(scored))
    for g in range(len(GENERATORS)):
        rows = rows.withColumn(f"_s{g}", F.expr(f"filter(_sel, x -> x.g = {g})"))
    rows = rows.withColumns({f"_i{g}": F.expr(_index(f"_s{g}")) for g in range(len(GENERATORS))})
    better = "(o.score > x.score OR o.score = x.score AND (o.end - o.start > x.end - x.start OR o.end - o.start = x.end - x.start AND o.start < x.start))"
    beaten = " OR ".join(f"exists({_meeting(f'_s{g}', f'_i{g}')}, o -> o.start < x.end AND x.start < o.end AND {better})" for g in range(len(GENERATORS)))
    # One long for a span: distinct longs are found by hashing, distinct structs by comparing all.
    packed = f"array_sort(array_distinct(transform(filter(_sel, x -> NOT ({beaten})), x -> x.start * 4294967296L + x.end)))"
    chosen = f"transform({packed}, x -> named_struct('start', int(x div 4294967296L), 'end', int(x % 4294967296L)))"
    return rows.select("_row", "_t", *[F.col(f"_{k}").alias(k) for k in KINDS], F.expr(chosen).alias("added"))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added: a row for each row of ``docs``.

    Spans are kind:start:end in code points, end exclusive, by kind (the added ones last, as ``other``) and start, joined by
    commas. Null or empty text has none; repeated rows get a row each; other columns are ignored.
    """
    df = find(docs.select(doc_id, text), model or fit(docs, text), text)
    joined = {k: F.expr(f"transform({k}, x -> concat('{k}:', x.start, ':', x.end))") for k in KINDS}
    added = F.expr("transform(added, x -> concat('other:', x.start, ':', x.end))")
    return df.select(
        F.col("_row").getField(doc_id).alias(doc_id),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.concat(*joined.values()), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*joined.values(), added), ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, text: str = "text", model: Model | None = None, mask: str = "[redacted]") -> DataFrame:
    """``docs`` with every span, base and added, replaced by ``mask``; overlapping spans are one. Null text stays null."""
    df = find(docs, model or fit(docs, text), text)
    spans = "array_sort(concat(added, " + ", ".join(f"transform({k}, x -> named_struct('start', x.start, 'end', x.end))" for k in KINDS) + "))"
    df = df.withColumn("_all", F.expr(spans))
    step = f"(a, x) -> named_struct('at', greatest(a.at, x.end), 'out', concat(a.out, CASE WHEN x.start >= a.at THEN concat(substr(_t, a.at + 1, x.start - a.at), {mask!r}) ELSE '' END))"
    new = F.expr(f"aggregate(_all, named_struct('at', 0, 'out', ''), {step}, a -> concat(a.out, substr(_t, a.at + 1)))")
    return df.select(*[F.when(F.col("_row").getField(text).isNotNull(), new).alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in docs.columns])
