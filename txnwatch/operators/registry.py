"""A registry of rules that share their exchanges.

A rule declares what it looks at: a row alone (``RowRule``) or the number of a key's rows in a trailing window
(``CountRule``). ``score`` groups the counting rules by key; each key's seconds are counted and shuffled once, whatever the
number of its rules (operators.prefix), and the row rules need no exchange. A new rule is one more entry of the list.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from txnwatch.functions.masking import sql_string
from txnwatch.functions.time import quote
from txnwatch.operators.prefix import BLOCK, with_counts


@dataclass(frozen=True)
class CountRule:
    """Fires on a row if its ``key`` has more than ``threshold`` rows in the ``window_minutes`` up to it, itself included."""

    tag: str
    key: str
    window_minutes: float
    threshold: int

    @property
    def seconds(self) -> int:
        return int(round(float(self.window_minutes) * 60))


@dataclass(frozen=True)
class RowRule:
    """Fires on a row for which the SQL ``condition`` is true."""

    tag: str
    condition: str


Rule = CountRule | RowRule


def score(df: DataFrame, rules: Sequence[Rule], ts: str = "timestamp", block: int = BLOCK) -> DataFrame:
    """A row for each row and rule that fires: ``df``'s columns, ``rule_type`` (the tag) and ``evidence`` (a counting rule's count).

    Tags tell rules apart and must differ. Without rules the result is empty, with the same columns. Null keys are a key
    of their own; rows without a time only meet row rules.
    """
    tags = [r.tag for r in rules]
    if len(set(tags)) != len(tags):
        raise ValueError(f"rules of one tag: {sorted(t for t in set(tags) if tags.count(t) > 1)}")
    columns = list(map(quote, df.columns))

    def fired(frame: DataFrame, tests: list[tuple[str, str, str]]) -> DataFrame:
        """Rows exploded by the (tag, condition, evidence) that hold."""
        each = ", ".join(f"CASE WHEN {condition} THEN struct({sql_string(tag)} AS rule_type, CAST({evidence} AS BIGINT) AS evidence) END" for tag, condition, evidence in tests)
        return frame.selectExpr(*columns, f"inline(filter(array({each}), x -> x IS NOT NULL))")

    branches = []
    alone = [r for r in rules if isinstance(r, RowRule)]
    if alone:
        branches.append(fired(df.where(" OR ".join(f"({r.condition})" for r in alone)), [(r.tag, r.condition, "NULL") for r in alone]))
    counting = [r for r in rules if isinstance(r, CountRule)]
    for key in dict.fromkeys(r.key for r in counting):
        same = [r for r in counting if r.key == key]
        # Rules of one window share its count.
        names = {s: f"__c{s}" for s in dict.fromkeys(r.seconds for r in same)}
        tests = [(r.tag, f"{names[r.seconds]} > {int(r.threshold)}", names[r.seconds]) for r in same]
        counted = with_counts(df, key, ts, {name: s for s, name in names.items()}, where=" OR ".join(t[1] for t in tests), block=block)
        branches.append(fired(counted, tests))
    if not branches:
        return df.where("false").selectExpr(*columns, "'' AS rule_type", "CAST(NULL AS BIGINT) AS evidence")
    return reduce(DataFrame.unionByName, branches)
