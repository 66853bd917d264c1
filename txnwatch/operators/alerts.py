"""Rule hits -> alert rows (PRJ-10..13, SNK-5, JOIN-5).

Everything is a native column expression: the rule's thresholds and texts are
literals chosen by ``rule_type`` (a four-way constant lookup Catalyst folds),
and ``trigger_detail`` is ``to_json`` of one struct whose fields that do not
apply to a rule are null and therefore omitted from the JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnwatch.config import (
    ALERT_PREFIX,
    RULE_IDS,
    TAG_GEO_JUMP,
    TAG_MERCHANT_VELOCITY,
    TAG_NIGHT_LARGE,
    TAG_VELOCITY,
    RuleSet,
)
from txnwatch.functions.time import epoch_seconds
from txnwatch.schemas import ALERT_COLUMNS


def alert_key(rule_type="rule_type", transaction_id="transaction_id") -> Column:
    """SNK-5: ``ALERT-<rule_type>-<transaction_id>``; stable across replays."""
    rt = F.col(rule_type) if isinstance(rule_type, str) else rule_type
    tx = F.col(transaction_id) if isinstance(transaction_id, str) else transaction_id
    return F.concat_ws("-", F.lit(ALERT_PREFIX), rt, tx)


def rule_id(rule_type="rule_type") -> Column:
    """PRJ-13: rule tag -> ``R1``..``R4`` (null for unknown tags)."""
    rt = F.col(rule_type) if isinstance(rule_type, str) else rule_type
    pairs = []
    for tag, rid in RULE_IDS.items():
        pairs.extend([F.lit(tag), F.lit(rid)])
    return F.create_map(*pairs)[rt]


def _per_rule(values: dict[str, object], dtype: str) -> Column:
    """``CASE rule_type WHEN tag THEN value ... END`` over literal values."""
    expr = None
    for tag, value in values.items():
        branch_value = F.lit(value).cast(dtype)
        expr = (F.when(F.col("rule_type") == tag, branch_value) if expr is None
                else expr.when(F.col("rule_type") == tag, branch_value))
    return expr if expr is not None else F.lit(None).cast(dtype)


def _only(tag: str, column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(F.col("rule_type") == tag, c)


def _utc_text(seconds: Column) -> Column:
    """Whole seconds as ISO-8601 text in UTC, whatever the session's zone."""
    wall = F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.concat(F.replace(wall.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def detail_struct(rules: RuleSet, event_sec: Column | None = None) -> Column:
    """PRJ-11: label, description, thresholds, then the rule's runtime evidence.

    Given the event's second, alerts of counting rules name the window they counted (STR-5): both ends belong to it.
    """
    sec = event_sec if event_sec is not None else F.lit(None).cast("long")
    spans = {TAG_VELOCITY: rules.r1, TAG_MERCHANT_VELOCITY: rules.r4}
    length = _per_rule({t: int(round(float(r.window_minutes) * 60)) for t, r in spans.items()}, "long")
    by_tag = {TAG_VELOCITY: rules.r1, TAG_GEO_JUMP: rules.r2,
              TAG_NIGHT_LARGE: rules.r3, TAG_MERCHANT_VELOCITY: rules.r4}
    label = {t: f"{RULE_IDS[t]}: {r.name} — {r.description}" for t, r in by_tag.items()}
    desc = {t: r.description for t, r in by_tag.items()}
    return F.struct(
        F.coalesce(_per_rule(label, "string"), F.col("rule_type")).alias("rule"),
        F.coalesce(_per_rule(desc, "string"), F.lit("")).alias("description"),
        _per_rule({TAG_VELOCITY: rules.r1.window_minutes,
                   TAG_MERCHANT_VELOCITY: rules.r4.window_minutes}, "double").alias("window_minutes"),
        _per_rule({TAG_VELOCITY: rules.r1.threshold,
                   TAG_MERCHANT_VELOCITY: rules.r4.threshold}, "int").alias("threshold"),
        _per_rule({TAG_GEO_JUMP: rules.r2.max_distance_km}, "double").alias("max_distance_km"),
        _per_rule({TAG_GEO_JUMP: rules.r2.max_interval_minutes}, "double")
        .alias("max_interval_minutes"),
        _per_rule({TAG_NIGHT_LARGE: rules.r3.min_amount}, "double").alias("min_amount"),
        _per_rule({TAG_NIGHT_LARGE: rules.r3.start_hour}, "int").alias("start_hour"),
        _per_rule({TAG_NIGHT_LARGE: rules.r3.end_hour}, "int").alias("end_hour"),
        _utc_text(sec - length).alias("window_start"),
        _utc_text(F.when(length.isNotNull(), sec)).alias("window_end"),
        _only(TAG_VELOCITY, "txn_count").alias("txn_count"),
        # the pseudonym, never the raw account id
        _only(TAG_VELOCITY, "user_hash").alias("user_hash"),
        _only(TAG_GEO_JUMP, F.round("distance_km", 2)).alias("distance_km"),
        _only(TAG_GEO_JUMP, F.round("time_diff_minutes", 2)).alias("time_diff_minutes"),
        _only(TAG_NIGHT_LARGE, "amount").alias("amount"),
        _only(TAG_MERCHANT_VELOCITY, "merchant_txn_count").alias("merchant_txn_count"),
        _only(TAG_MERCHANT_VELOCITY, "merchant_id").alias("merchant_id"),
    )


def to_alerts(hits: DataFrame, rules: RuleSet | None = None, alert_time: Column | None = None,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-10: the 8-column alert row; ``keep`` names columns of the hit to carry behind it.

    ``alert_time`` defaults to the query's ``current_timestamp()``; streaming
    passes one stamp per micro-batch so a replay writes identical rows.
    """
    rules = rules or RuleSet()
    stamp = alert_time if alert_time is not None else F.current_timestamp()
    keyed = hits.selectExpr(f"concat_ws('-', '{ALERT_PREFIX}', rule_type, transaction_id) AS alert_id",
                            "rule_type", "transaction_id", "user_hash", "amount", "`timestamp`",
                            "txn_count", "distance_km", "time_diff_minutes",
                            "merchant_txn_count", "merchant_id", *keep)
    return keyed.select(*ALERT_COLUMNS[:6], F.to_json(detail_struct(rules, epoch_seconds(keyed, "timestamp"))).alias("trigger_detail"),
                        stamp.alias("alert_time"), *keep)


# Fields of ``trigger_detail`` that reports and tests read back, with types.
DETAIL_FIELDS = {
    "detail_rule": ("rule", "string"),
    "detail_description": ("description", "string"),
    "detail_window_minutes": ("window_minutes", "double"),
    "detail_threshold": ("threshold", "int"),
    "detail_max_distance_km": ("max_distance_km", "double"),
    "detail_max_interval_minutes": ("max_interval_minutes", "double"),
    "detail_min_amount": ("min_amount", "double"),
    "detail_start_hour": ("start_hour", "int"),
    "detail_end_hour": ("end_hour", "int"),
    "detail_txn_count": ("txn_count", "bigint"),
    "detail_user_hash": ("user_hash", "string"),
    "detail_distance_km": ("distance_km", "double"),
    "detail_time_diff_minutes": ("time_diff_minutes", "double"),
    "detail_amount": ("amount", "double"),
    "detail_merchant_txn_count": ("merchant_txn_count", "bigint"),
    "detail_merchant_id": ("merchant_id", "string"),
}


def explode_detail(alerts: DataFrame) -> DataFrame:
    """Read the JSON detail back into typed columns (one parse per row)."""
    schema = ", ".join(f"{field} {dtype}" for field, dtype in DETAIL_FIELDS.values())
    parsed = alerts.selectExpr("*", f"from_json(trigger_detail, '{schema}') AS __detail")
    return parsed.selectExpr("*", *[f"__detail.{field} AS {name}"
                                    for name, (field, _) in DETAIL_FIELDS.items()]).drop("__detail")
