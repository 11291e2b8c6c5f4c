"""Business constants and silver column types, all replaceable per deployment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import types as T

# Money sums stay exact (and so independent of task order and retries) because
# decimal(18,4) sums to decimal(28,4) and money x rate still fits 38 digits.
MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(9, 6)


# Event spellings after strip + lower, with their report label.
EVENT_LABELS = {
    "visit": "Visit",
    "add_to_cart": "Add_To_Cart",
    "purchase": "Purchase",
}

# Region -> (shortfall type, risk level), and the default pair.
REGION_RULES = {
    "South": ("Funnel Drop-off", "High"),
    "East": ("Pricing Erosion", "Medium"),
    "West": ("Operational Gap", "Medium"),
}
DEFAULT_RULE = ("Funnel Drop-off", "Low")

# Share of the shortfall each scenario expects to win back.
SCENARIOS = {
    "conservative": Decimal("0.75"),
    "realistic": Decimal("0.85"),
    "aggressive": Decimal("0.95"),
}


# The scenario behind the recovery potential measure.
RECOVERY_SCENARIO = "realistic"


@dataclass(frozen=True)
class Settings:
    order_value_cap: int = 50000
    default_signup_date: dt.date = dt.date(2023, 1, 1)
    target_date_formats: tuple[str, ...] = ("yyyy-MM-dd", "yyyy/MM/dd")
    event_labels: Mapping[str, str] = field(default_factory=lambda: dict(EVENT_LABELS))

    # How regions and product ids compare from gold on: as in a warehouse whose collation
    # ignores case and accents. None where the source is known to spell them one way.
    collation: str | None = "UNICODE_CI_AI"

    uplift_region: str = "West"
    uplift_factor: Decimal = Decimal("1.05")
    target_scale: Decimal = Decimal("1.4")

    region_rules: Mapping[str, tuple[str, str]] = field(
        default_factory=lambda: dict(REGION_RULES)
    )
    default_rule: tuple[str, str] = DEFAULT_RULE
    assumed_conversion_rate: Decimal = Decimal("0.07")
    scenarios: Mapping[str, Decimal] = field(default_factory=lambda: dict(SCENARIOS))
    fixed_leakage_rate: Decimal = Decimal("0.05")

    money: T.DecimalType = MONEY
    rate: T.DecimalType = RATE
    base_price: T.DataType = T.LongType()
    text_width: int | None = None  # of text columns in an external database; None: unbounded

    def __post_init__(self) -> None:
        missing = set(EVENT_LABELS) - set(self.event_labels)
        if missing:
            raise ValueError(f"event_labels lacks {sorted(missing)}")
        if RECOVERY_SCENARIO not in self.scenarios:
            raise ValueError(f"scenarios lacks {RECOVERY_SCENARIO!r}, the one measures report")
