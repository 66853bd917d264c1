"""Rule parameters and the fixed values every result depends on.

Thresholds are plain, immutable parameters.  ``load_rules`` reads the same
layout from YAML (one mapping per rule id) so operators can switch rules off
or retune them without touching code.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to line up)
# ---------------------------------------------------------------------------
# Rule tags, in rule-id order R1, R2, R3, R4.
TAG_VELOCITY = "VELOCITY_FRAUD"
TAG_GEO_JUMP = "GEO_JUMP"
TAG_NIGHT_LARGE = "NIGHT_LARGE"
TAG_MERCHANT_VELOCITY = "MERCHANT_VELOCITY"
# Rule tag -> rule id.
RULE_IDS = {
    TAG_VELOCITY: "R1",
    TAG_GEO_JUMP: "R2",
    TAG_NIGHT_LARGE: "R3",
    TAG_MERCHANT_VELOCITY: "R4",
}
# Mean Earth radius in km used by the great-circle distance.
EARTH_RADIUS_KM = 6371.0
# Alert triage per rule id: (severity, response time in minutes).
SEVERITY = {
    "R1": ("high", 5),
    "R2": ("high", 10),
    "R3": ("medium", 60),
    "R4": ("medium", 30),
}
# Event-time watermark of the streaming job.
DEFAULT_WATERMARK = "10 minutes"
# Alert-key prefix: ALERT-<rule_type>-<transaction_id>.
ALERT_PREFIX = "ALERT"
# ---------------------------------------------------------------------------

DEFAULT_SALT = "txnwatch-pii-salt"


@dataclass(frozen=True)
class VelocityRule:
    """R1: more than ``threshold`` transactions of one user in ``[t-W, t]``."""

    enabled: bool = True
    window_minutes: float = 5
    threshold: int = 5
    name: str = "Velocity fraud"
    text: str | None = None

    @property
    def description(self) -> str:
        return self.text or (f"more than {self.threshold} transactions by one user "
                             f"within {self.window_minutes:g} minutes")


@dataclass(frozen=True)
class GeoJumpRule:
    """R2: consecutive transactions of a user far apart and close in time."""

    enabled: bool = True
    max_distance_km: float = 1000
    max_interval_minutes: float = 10
    name: str = "Geo jump"
    text: str | None = None

    @property
    def description(self) -> str:
        return self.text or (f"consecutive transactions of one user more than "
                             f"{self.max_distance_km:g} km apart within "
                             f"{self.max_interval_minutes:g} minutes")


@dataclass(frozen=True)
class NightLargeRule:
    """R3: amount above ``min_amount`` at an hour in ``[start_hour, end_hour)``."""

    enabled: bool = True
    min_amount: float = 5000
    start_hour: int = 0
    end_hour: int = 5
    name: str = "Night large amount"
    text: str | None = None

    @property
    def description(self) -> str:
        return self.text or (f"amount above {self.min_amount:g} between "
                             f"{self.start_hour:02d}:00 and {self.end_hour:02d}:00")


@dataclass(frozen=True)
class MerchantVelocityRule:
    """R4: more than ``threshold`` transactions at one merchant in ``[t-W, t]``."""

    enabled: bool = True
    window_minutes: float = 1
    threshold: int = 3
    name: str = "Merchant velocity"
    text: str | None = None

    @property
    def description(self) -> str:
        return self.text or (f"more than {self.threshold} transactions at one merchant "
                             f"within {self.window_minutes:g} minutes")


@dataclass(frozen=True)
class RuleSet:
    r1: VelocityRule = field(default_factory=VelocityRule)
    r2: GeoJumpRule = field(default_factory=GeoJumpRule)
    r3: NightLargeRule = field(default_factory=NightLargeRule)
    r4: MerchantVelocityRule = field(default_factory=MerchantVelocityRule)
    salt: str = DEFAULT_SALT

    def by_id(self) -> dict:
        return {"R1": self.r1, "R2": self.r2, "R3": self.r3, "R4": self.r4}

    def replace(self, **changes) -> "RuleSet":
        """``rules.replace(r1=dict(window_minutes=60, threshold=1))``."""
        updated = {}
        for key, value in changes.items():
            if isinstance(value, dict):
                value = dataclasses.replace(getattr(self, key), **value)
            updated[key] = value
        return dataclasses.replace(self, **updated)


_KEYS = {"R1": "r1", "R2": "r2", "R3": "r3", "R4": "r4"}


def load_rules(path: str, salt: str | None = None) -> RuleSet:
    """Read ``rules: {R1: {...}, ...}`` YAML into a :class:`RuleSet`.

    Unknown keys (such as ``type``) are ignored; missing keys keep defaults.
    """
    import yaml

    with open(path, encoding="utf-8") as fh:
        raw = yaml.safe_load(fh) or {}
    rules = raw.get("rules", raw)
    base = RuleSet() if salt is None else RuleSet(salt=salt)
    changes = {}
    for rule_id, attr in _KEYS.items():
        if rule_id not in rules:
            continue
        current = getattr(base, attr)
        allowed = {f.name for f in dataclasses.fields(current)}
        given = dict(rules[rule_id])
        if "description" in given:
            given["text"] = given.pop("description")
        values = {k: v for k, v in given.items() if k in allowed}
        changes[attr] = dataclasses.replace(current, **values)
    return dataclasses.replace(base, **changes)
