"""Bands and labels over numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(tests: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """First label whose test holds. A NULL test does not hold."""
    first, *rest = tests
    chain = F.when(first[0], first[1])
    for test, label in rest:
        chain = chain.when(test, label)
    return chain if otherwise is None else chain.otherwise(otherwise)


def tenure_band(years: Column) -> Column:
    # Labels and limits of the tenure bands.
    return ladder(
        [
            (years < 1, "New (<1 yr)"),
            (years < 3, "Developing (1-3 yrs)"),
            (years < 5, "Experienced (3-5 yrs)"),
        ],
        "Veteran (5+ yrs)",
    )


def performance_band(rating: Column, mode: str = "as_coded") -> Column:
    """``as_coded`` tests <=5 first, so every rating up to 5 is "Exceptional"."""
    # Labels of the performance bands.
    if mode == "as_coded":
        tests = [
            (rating <= 5, "Exceptional"),
            (rating <= 4, "Exceeds Expectations"),
            (rating <= 3, "Meets Expectations"),
            (rating >= 2, "Needs Improvement"),
        ]
    elif mode == "intended":
        tests = [
            (rating >= 5, "Exceptional"),
            (rating >= 4, "Exceeds Expectations"),
            (rating >= 3, "Meets Expectations"),
            (rating >= 2, "Needs Improvement"),
        ]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return ladder(tests, "Unsatisfactory")


def order_bucket(orders: Column) -> Column:
    # Labels and limits of the order-count buckets.
    return ladder(
        [
            (orders.isNull(), "0"),
            (orders == 1, "1"),
            (orders <= 3, "2-3"),
            (orders <= 5, "4-5"),
            (orders <= 10, "6-10"),
            (orders <= 20, "11-20"),
        ],
        "20+",
    )


def rating_label(average: Column) -> Column:
    # Labels and limits of the average-rating tiers.
    return ladder(
        [(average >= 4.5, "Top Tier"), (average >= 3.5, "Strong"), (average >= 2.5, "Needs Development")],
        "Low",
    )


# Fixed values: (warning, critical) limits per sensor metric; both are exceeded strictly.
SEVERITY_LIMITS = {
    "temperature_celsius": (90.0, 100.0),
    "pressure_psi": (38.0, 42.0),
    "vibration_mms": (4.0, 5.5),
    "humidity_percent": (65.0, 75.0),
}


def severity(metric: str) -> Column:
    """'critical', 'warning' or 'normal' for one metric of a reading; NULL without a value."""
    warning, critical = SEVERITY_LIMITS[metric]
    value = F.col(metric)
    return ladder(
        [(value > critical, "critical"), (value > warning, "warning"), (value.isNotNull(), "normal")]
    )
