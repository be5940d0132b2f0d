"""Domain column rules (survey 2.D).  Each returns a native ``Column``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import _c, hours_between, null_greatest0

# FIXED VALUES — band labels and thresholds used across the models.
ON_TIME, MINOR, MODERATE, SEVERE = "ON_TIME", "MINOR_DELAY", "MODERATE_DELAY", "SEVERE_DELAY"
DELAY_CATEGORIES = [ON_TIME, MINOR, MODERATE, SEVERE]
CONGESTION_LEVELS = ["CRITICAL", "HIGH", "MODERATE", "NORMAL"]
CLEARANCE_BANDS = ["FAST", "STANDARD", "SLOW", "CRITICAL"]
VAT_RATE = 0.12
DEFAULT_FX = 56.0
CONGESTED_WAIT_H = 24
SLA_DAYS = 5


def delay_hours(eta, ata, hour_mode: str = "boundary") -> Column:
    """Hour difference eta -> ata clamped at 0, NULL while in transit."""
    return null_greatest0(hours_between(eta, ata, hour_mode))


def delay_category(eta, ata, clamp: bool = False, hour_mode: str = "boundary") -> Column:
    """Delay band on the *unclamped* difference (reference SQL).

    ``clamp=True`` bands the clamped value instead (the prose reading:
    early arrivals are ON_TIME).  A NULL ``ata`` falls through to SEVERE.
    """
    d = hours_between(eta, ata, hour_mode)
    if clamp:
        d = null_greatest0(d)
    return (F.when(d == 0, ON_TIME)
            .when(d <= 24, MINOR)
            .when(d <= 72, MODERATE)
            .otherwise(SEVERE))


def event_type(ata, delay_h, category) -> Column:
    """Shipment event label; the order of the tests matters."""
    ata, delay_h, category = _c(ata), _c(delay_h), _c(category)
    return (F.when(ata.isNull(), "IN_TRANSIT")
            .when(delay_h == 0, "ARRIVED_ON_TIME")
            .when(category == MINOR, "ARRIVED_MINOR_DELAY")
            .when(category == MODERATE, "ARRIVED_MODERATE_DELAY")
            .otherwise("ARRIVED_SEVERE_DELAY"))


def is_congested(wait_h) -> Column:
    """Anchorage wait above 24 h; NULL wait is not congested."""
    return F.coalesce(_c(wait_h) > CONGESTED_WAIT_H, F.lit(False))


def congestion_level(rate_pct) -> Column:
    """Level from a congestion percentage; NULL is NORMAL."""
    r = _c(rate_pct)
    return (F.when(r >= 60, "CRITICAL").when(r >= 35, "HIGH")
            .when(r >= 15, "MODERATE").otherwise("NORMAL"))


def is_sla_breach(days) -> Column:
    """Processing days above 5; NULL is not a breach."""
    return F.coalesce(_c(days) > SLA_DAYS, F.lit(False))


def clearance_band(days) -> Column:
    """Clearance speed band; NULL falls through to CRITICAL."""
    d = _c(days)
    return (F.when(d <= 2, "FAST").when(d <= 5, "STANDARD")
            .when(d <= 10, "SLOW").otherwise("CRITICAL"))
