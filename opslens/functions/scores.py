"""Scores, tiers and segments as column expressions.

The arithmetic is written in the same operator order as the business rule
(``weight * value / scale`` summed left to right), so the doubles produced
are bit-identical to any engine evaluating the same formula.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights, scales and thresholds of the business rules.
# Maintenance priority: 0.3*temperature/100 + 0.25*vibration/10
#                       + 0.15*anomaly_flag + 0.3*downtime_risk
MAINTENANCE_WEIGHTS = (0.3, 0.25, 0.15, 0.3)
MAINTENANCE_SCALES = (100, 10)
ALERT_THRESHOLD = 0.7
ALERT_TYPE = "HIGH_MAINTENANCE_PRIORITY"
ALERT_ACTION = "Schedule immediate maintenance"
# Customer value: 0.4*amount/1000 + 0.3*frequency/10 + 0.15*loyalty/10
#                 + 0.15*satisfaction/10
CUSTOMER_WEIGHTS = (0.4, 0.3, 0.15, 0.15)
CUSTOMER_SCALES = (1000, 10, 10, 10)
# Segment on the stream score: > 0.6 HIGH_VALUE, > 0.4 MEDIUM_VALUE.
STREAM_SEGMENT_THRESHOLDS = (0.6, 0.4)
# Segment on max satisfaction in the ETL: > 0.8 HIGH_VALUE, > 0.5 MEDIUM_VALUE.
ETL_SEGMENT_THRESHOLDS = (0.8, 0.5)
SEGMENTS = ("HIGH_VALUE", "MEDIUM_VALUE", "STANDARD")
ERROR_SEGMENT = "ERROR"
# Machine efficiency is remaining life / energy, clamped to [0, 500].
EFFICIENCY_CAP = 500
# Risk tiers of a machine's latest score: > 0.7 high, > 0.4 medium, else low.
RISK_THRESHOLDS = (0.7, 0.4)


def maintenance_priority(temperature: Column, vibration: Column,
                         anomaly_flag: Column, downtime_risk: Column) -> Column:
    """Unrounded maintenance priority; null when any input is null."""
    w_t, w_v, w_a, w_d = MAINTENANCE_WEIGHTS
    s_t, s_v = MAINTENANCE_SCALES
    return ((F.lit(w_t) * temperature / s_t)
            + (F.lit(w_v) * vibration / s_v)
            + (F.lit(w_a) * anomaly_flag)
            + (F.lit(w_d) * downtime_risk))


def customer_value(amount: Column, frequency: Column,
                   loyalty: Column, satisfaction: Column) -> Column:
    """Unrounded customer value score; null when any input is null."""
    w_a, w_f, w_l, w_s = CUSTOMER_WEIGHTS
    s_a, s_f, s_l, s_s = CUSTOMER_SCALES
    return ((F.lit(w_a) * amount / s_a)
            + (F.lit(w_f) * frequency / s_f)
            + (F.lit(w_l) * loyalty / s_l)
            + (F.lit(w_s) * satisfaction / s_s))


def tier(value: Column, thresholds: tuple[float, float], labels: tuple[str, str, str]) -> Column:
    """Three-way label: > high, > mid, else the last (null -> last)."""
    high, mid = thresholds
    return (F.when(value > high, labels[0])
            .when(value > mid, labels[1])
            .otherwise(labels[2]))


def stream_segment(score: Column) -> Column:
    """Segment of a stream score; NaN is above no threshold."""
    return tier(F.when(~F.isnan(score), score), STREAM_SEGMENT_THRESHOLDS, SEGMENTS)


def etl_segment(max_satisfaction: Column) -> Column:
    return tier(max_satisfaction, ETL_SEGMENT_THRESHOLDS, SEGMENTS)


def machine_efficiency(remaining_life: Column, energy: Column) -> Column:
    """0 when energy <= 0, else life / energy clamped to [0, cap].

    ``least``/``greatest`` skip nulls, so a null life or energy gives 0; the
    guard keeps the ANSI division from seeing a zero divisor.
    """
    ratio = F.least(F.lit(EFFICIENCY_CAP).cast("double"),
                    F.greatest(F.lit(0.0), remaining_life / energy))
    return F.when(energy <= 0, F.lit(0.0)).otherwise(ratio)
