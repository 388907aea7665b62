"""Text labels derived from ids and measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed values: (upper bound in days, band) in ascending order, and the band beyond.
WEB_BANDS = ([(1, "critical")], "high")
DESK_BANDS = ([(2, "critical"), (4, "high")], "normal")

# Label cycles for store regions and SKU categories.
REGIONS = ["Northeast", "Southeast", "Midwest", "Southwest", "West"]
CATEGORIES = ["beverages", "snacks", "dairy", "produce", "frozen",
              "personal_care", "household", "bakery"]


def urgency_band(days: Column, cuts: Sequence[tuple[float, str]], beyond: str) -> Column:
    """First band whose upper bound lies above ``days``; an unknown value counts as 0."""
    value = F.coalesce(days, F.lit(0.0))
    band = F
    for bound, label in cuts:
        band = band.when(value < bound, label)
    return band.otherwise(beyond)


def padded_id(prefix: str, key: Column, width: int) -> Column:
    """``prefix`` and the zero-padded id. Longer ids keep all digits (``lpad`` would cut them)."""
    return F.format_string(f"{prefix}%0{width}d", key)


def round_robin(key: Column, labels: Sequence[str]) -> Column:
    """Label number ``key mod n``."""
    position = F.pmod(key, F.lit(len(labels))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(label) for label in labels]), position)
