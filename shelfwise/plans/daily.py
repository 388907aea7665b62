"""Mergeable daily figures: what a date adds to trends and coverage, stored once and combined over any dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions import percent
from shelfwise.operators import latest_date, with_skus
from shelfwise.plans.kpis import is_reorder, revenue

MONEY, MONTH = "decimal(28,6)", "month"


def daily_figures(history: DataFrame, skus: DataFrame) -> DataFrame:
    """``signal_date`` with additive counts and the value at risk, as an exact decimal, of its signals.

    Signals of one date, SKU and stored demand have the same value, so they are counted before they meet the SKUs.
    """
    at_risk = F.when(is_reorder(), F.col("avg_daily_demand_7d")).alias("avg_daily_demand_7d")
    alike = history.groupBy("signal_date", "sku_id", at_risk).agg(
        F.count(F.lit(1)).alias("combos"), F.count_if(is_reorder()).alias("reorder"))
    return with_skus(alike, skus, "left").groupBy("signal_date").agg(
        F.sum("combos").alias("combos"),
        F.sum("reorder").alias("reorder"),
        F.coalesce(F.sum(revenue().cast(MONEY) * F.col("reorder")), F.lit(0)).cast("decimal(38,6)").alias("value"),
    )


def trend_of(daily: DataFrame, days: int | None = 30) -> DataFrame:
    """The trend of :func:`kpis.status_trend`, from daily figures alone."""
    if days:
        daily = daily.where(F.col("signal_date") > F.date_sub(latest_date(daily, "signal_date"), days))
    return daily.groupBy("signal_date").agg(
        F.sum("combos").alias("store_sku_combos"),
        F.sum("reorder").alias("reorder_now"),
        percent(F.sum("reorder"), F.sum("combos")).alias("stockout_rate_pct"),
        F.round(F.sum("value").cast("double"), 0).alias("weekly_revenue_at_risk"),
    ).orderBy("signal_date")


def daily_coverage(history: DataFrame) -> DataFrame:
    """``signal_date, dimension, bucket, bitmap``: the stores and the SKUs that report on a date, as bitmaps.

    Bitmaps merge over dates without counting a key twice; a bucket holds 32,768 keys. Keys that are null do not count.
    """
    keys = history.select("signal_date", F.explode(F.create_map(
        F.lit("stores"), "store_id", F.lit("skus"), "sku_id")).alias("dimension", "key")).where(F.col("key").isNotNull())
    place = F.bitmap_bit_position("key")
    return keys.groupBy("signal_date", "dimension", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(place).alias("bitmap"))


def by_month(rows: DataFrame) -> DataFrame:
    """With the first day of the month, by which daily figures are stored: a date alone makes too small a file."""
    return rows.withColumn(MONTH, F.trunc("signal_date", "month"))


def coverage_of(coverage: DataFrame) -> DataFrame:
    """One row: distinct ``stores`` and ``skus`` over all dates of ``coverage``."""
    merged = coverage.groupBy("dimension", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    total = lambda name: F.coalesce(F.sum(F.when(
        F.col("dimension") == name, F.bitmap_count("bitmap"))), F.lit(0).cast("bigint")).alias(name)
    return merged.agg(total("stores"), total("skus"))
