"""Ordered first-k rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """Per-task heaps of k rows, merged: no full sort. ``order`` must break all ties."""
    return df.orderBy(*order).limit(k)
