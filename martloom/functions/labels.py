"""Segment labels of a customer."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SegmentThresholds:
    """Limits of the recency, frequency and monetary bands."""

    active_days: int = 100
    lapsing_days: int = 300
    high_frequency_above: int = 5
    medium_frequency_from: int = 3
    high_value_above: int = 100_000
    medium_value_from: int = 50_000


# Segment, recency, frequencies, values (None: any value). First match wins.
SEGMENT_RULES = (
    ("Champions", "Active", ("High Frequency", "Medium Frequency"), ("High Value",)),
    ("Potential Loyalists", "Lapsing", ("High Frequency",), ("High Value",)),
    ("Hibernating", "Lapsing", ("Medium Frequency",), ("Medium Value", "High Value")),
    ("New User", "Active", ("Low Frequency",), None),
)
DEFAULT_SEGMENT = "At Risk"


def banded(*bands: tuple[Column, str], default: str) -> Column:
    """Label of the first band reached; ``default`` when none is, or the value is null."""
    return reduce(
        lambda rest, band: F.when(band[0], F.lit(band[1])).otherwise(rest),
        reversed(bands),
        F.lit(default),
    )


def recency_label(last_purchase: Column, latest: Column, limits: SegmentThresholds) -> Column:
    return banded(
        (last_purchase >= F.date_sub(latest, limits.active_days), "Active"),
        (last_purchase >= F.date_sub(latest, limits.lapsing_days), "Lapsing"),
        default="Inactive",
    )


def frequency_label(orders: Column, limits: SegmentThresholds) -> Column:
    return banded(
        (orders > limits.high_frequency_above, "High Frequency"),
        (orders >= limits.medium_frequency_from, "Medium Frequency"),
        default="Low Frequency",
    )


def value_label(amount: Column, limits: SegmentThresholds) -> Column:
    return banded(
        (amount > limits.high_value_above, "High Value"),
        (amount >= limits.medium_value_from, "Medium Value"),
        default="Low Value",
    )


def segment_label(recency: Column, frequency: Column, value: Column) -> Column:
    """Overall segment by the first matching row of the rule table."""

    def matches(rule) -> Column:
        _, wanted_recency, frequencies, values = rule
        hit = (recency == wanted_recency) & frequency.isin(*frequencies)
        return hit if values is None else hit & value.isin(*values)

    return reduce(
        lambda rest, rule: F.when(matches(rule), F.lit(rule[0])).otherwise(rest),
        reversed(SEGMENT_RULES),
        F.lit(DEFAULT_SEGMENT),
    )
