"""Day-of-week seasonality."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Demand factors by day of week (1 = Sunday ... 7 = Saturday).
WEEKEND = (1, 7)
MONDAY = 2
WEEKEND_FACTOR = 1.25
MONDAY_FACTOR = 0.90


def day_of_week(date: Column) -> Column:
    return F.dayofweek(date)


def dow_factor(date: Column) -> Column:
    dow = day_of_week(date)
    return (
        F.when(dow.isin(*WEEKEND), WEEKEND_FACTOR)
        .when(dow == MONDAY, MONDAY_FACTOR)
        .otherwise(1.0)
    )
