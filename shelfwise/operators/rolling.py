"""Trailing means over a fixed number of rows per store and SKU."""

from __future__ import annotations

from pyspark.sql import Column, Window, functions as F

from shelfwise.schemas import PAIR


def rolling_mean(value: str, rows: int) -> Column:
    """Mean of the current and the ``rows - 1`` preceding rows; early frames are shorter.

    Frames count rows, not days. All frames share one partitioning and sort.
    """
    by_date = Window.partitionBy(*PAIR).orderBy("transaction_date")
    return F.avg(value).over(by_date.rowsBetween(1 - rows, Window.currentRow))
