"""Aggregates whose result does not depend on how rows are partitioned.

Adding doubles in a different order moves the last bits, which then shows
after rounding. Summing decimals is order-free, and decimal buffers still fit
Spark's hash aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAYS_AT_RISK = 7


def exact_sum(value: Column, scale: int = 6) -> Column:
    return F.sum(value.cast(f"decimal(28,{scale})")).cast("double")


def exact_mean(value: Column, scale: int = 6) -> Column:
    """Mean over non-NULL values; NULL when there are none."""
    return F.try_divide(exact_sum(value, scale), F.count(value))


def at_risk_value(demand: Column, price: Column) -> Column:
    """One week of the stored (rounded) daily demand at the SKU's average price."""
    return demand * price * DAYS_AT_RISK


def percent(part: Column, whole: Column) -> Column:
    """Share in percent, one decimal; NULL for an empty whole."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), 1)
