"""Days of supply and the status derived from it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwise.schemas import OK, REORDER_DAYS, REORDER_NOW, WATCH, WATCH_DAYS

POLICIES = ("ok", "reorder_if_empty")


def days_of_supply(inventory: Column, demand: Column) -> Column:
    """Unrounded stock-to-demand ratio; NULL when there is no demand."""
    return inventory / F.nullif(demand, F.lit(0.0))


def status(
    ratio: Column,
    inventory: Column | None = None,
    *,
    reorder_days: float = REORDER_DAYS,
    watch_days: float = WATCH_DAYS,
    zero_demand_policy: str = "ok",
) -> Column:
    """REORDER NOW / WATCH / OK from the *unrounded* ratio; both bounds are strict.

    A NULL ratio (no demand, or unknown stock) is OK. ``reorder_if_empty``
    instead flags a shelf that is known to be empty.
    """
    if zero_demand_policy not in POLICIES:
        raise ValueError(f"zero_demand_policy must be one of {POLICIES}")
    label = F.when(ratio < reorder_days, REORDER_NOW).when(ratio < watch_days, WATCH)
    if zero_demand_policy == "reorder_if_empty":
        label = label.when(ratio.isNull() & (inventory <= 0), REORDER_NOW)
    return label.otherwise(OK)
