"""Latest-date selection."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.schemas import PAIR


def latest_date(df: DataFrame, column: str = "transaction_date") -> Column:
    """Maximum date as a scalar subquery: it stays in the plan and can prune partitions."""
    return df.select(F.max(column)).scalar()


def on_latest_date(
    df: DataFrame, dates: DataFrame | None = None, as_of: datetime.date | None = None
) -> DataFrame:
    """Rows of the one global latest date.

    ``dates`` may name a cheaper frame with the same maximum, e.g. bronze for an
    unmaterialised silver plan; ``as_of`` gives the date where it is known.
    """
    if as_of is not None:
        return df.where(F.col("transaction_date") == F.lit(as_of))
    source = df if dates is None else dates
    return df.where(F.col("transaction_date") == latest_date(source))


def on_latest_per_pair(df: DataFrame) -> DataFrame:
    """The last row of every store and SKU.

    The rank becomes a group limit: over stored rows each task sends one row per pair;
    over rows that the rolling window has gathered by pair there is no further shuffle.
    """
    newest = Window.partitionBy(*PAIR).orderBy(F.desc("transaction_date"))
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")
