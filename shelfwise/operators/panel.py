"""Calendar spines and gap filling.

The spine covers every pair that trades, on every date. Dates are generated per
pair, so no join and no product of stores and SKUs is needed, and the row count
is exactly that of the result.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.latest import latest_date
from shelfwise.schemas import PAIR, POS


def _days(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("INTERVAL 1 DAY")))


def first_date(df: DataFrame) -> Column:
    return df.select(F.min("transaction_date")).scalar()


def date_spine(df: DataFrame) -> DataFrame:
    """Every date from the first to the last."""
    span = df.agg(F.min("transaction_date").alias("start"), F.max("transaction_date").alias("end"))
    return span.where("start IS NOT NULL").select(
        _days(F.col("start"), F.col("end")).alias("transaction_date"))


def panel_spine(pos: DataFrame) -> DataFrame:
    """One row per trading pair and date."""
    pairs = pos.select(*PAIR).distinct()
    return pairs.select(*PAIR, _days(first_date(pos), latest_date(pos)).alias("transaction_date"))


def dense_daily(deduped: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Gap-filled daily panel: missing days sell 0 and are flagged.

    Each row emits its own day and the gap up to the pair's next row; a pair's
    first row also emits the days before it. One shuffle on the pair, no join.
    Price and stock of a missing day are unknown, hence NULL.
    """
    span = deduped if dates is None else dates
    by_date = Window.partitionBy(*PAIR).orderBy("transaction_date")
    day = F.col("transaction_date")
    start = F.when(F.lag(day).over(by_date).isNull(), first_date(span)).otherwise(day)
    end = F.coalesce(F.date_sub(F.lead(day).over(by_date), 1), latest_date(span))
    gap = F.col("_day") != day
    return (
        deduped.withColumn("_start", start).withColumn("_end", end)
        .withColumn("_day", _days(F.col("_start"), F.col("_end")))
        .select(
            *PAIR, F.col("_day").alias("transaction_date"),
            F.when(gap, 0).otherwise(F.col("qty_sold")).alias("qty_sold"),
            F.when(~gap, F.col("unit_price")).alias("unit_price"),
            F.when(~gap, F.col("inventory_on_hand")).alias("inventory_on_hand"),
            gap.alias("is_gap"),
        )
    )


def panel_since(
    rows: DataFrame, end: datetime.date, known: DataFrame | None = None, start: datetime.date | None = None
) -> DataFrame:
    """The panel's rows up to ``end``, from each pair's first row on.

    ``rows`` are deduplicated. With ``start`` they begin there, and ``known`` holds the pairs that traded
    before: these have a row on every date from ``start`` on. A known pair enters as a mark on the day before, so the
    gap that it carries over is generated like any other: one shuffle on the pair, no join.
    """
    day = F.col("transaction_date")
    marked = rows.where(day.isNotNull()).select(*POS.names).withColumn("_mark", F.lit(False))
    if known is not None and start is not None:
        eve = F.lit(start - datetime.timedelta(days=1)).alias("transaction_date")
        marks = known.select(*PAIR, eve, F.lit(True).alias("_mark"))
        marked = marked.unionByName(marks, allowMissingColumns=True)
    by_date = Window.partitionBy(*PAIR).orderBy("transaction_date")
    spans = marked.withColumn("_end", F.coalesce(F.date_sub(F.lead(day).over(by_date), 1), F.lit(end))).withColumn(
        "_start", F.when(F.col("_mark"), F.date_add(day, 1)).otherwise(day))
    gap = F.col("_day") != day
    return (
        spans.where(F.col("_start") <= F.col("_end"))
        .withColumn("_day", _days(F.col("_start"), F.col("_end")))
        .select(
            *PAIR, F.col("_day").alias("transaction_date"),
            F.when(gap, 0).otherwise(F.col("qty_sold")).alias("qty_sold"),
            F.when(~gap, F.col("unit_price")).alias("unit_price"),
            F.when(~gap, F.col("inventory_on_hand")).alias("inventory_on_hand"),
            gap.alias("is_gap"),
        )
    )


def first_sales(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``store_id, sku_id, first_date`` of every pair in ``rows`` and in the earlier result ``known``."""
    dated = rows.where(F.col("transaction_date").isNotNull())
    dates = dated.select(*PAIR, F.col("transaction_date").alias("first_date"))
    if known is not None:
        dates = dates.unionByName(known)
    return dates.groupBy(*PAIR).agg(F.min("first_date").alias("first_date"))


def whole_panel(panel: DataFrame, firsts: DataFrame) -> DataFrame:
    """The panel of :func:`dense_daily` from stored rows and first dates: the days before a pair's first row are
    generated when it is read, so a pair that starts late rewrites no earlier date."""
    start = firsts.select(F.min("first_date")).scalar()
    late = firsts.withColumn("_start", start).where(F.col("first_date") > F.col("_start"))
    before = late.select(
        *PAIR, _days(F.col("_start"), F.date_sub("first_date", 1)).alias("transaction_date"),
        F.lit(0).alias("qty_sold"), F.lit(None).cast("double").alias("unit_price"),
        F.lit(None).cast("int").alias("inventory_on_hand"), F.lit(True).alias("is_gap"))
    return panel.unionByName(before)
