"""Business questions over gold and the dimensions, as parameterised queries.

"Below n days" tests the stored, rounded days of supply; "needs an order" tests
the status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions import exact_mean, exact_sum, percent
from shelfwise.operators import top_k, with_dimensions, with_skus, with_stores
from shelfwise.plans.kpis import is_reorder, reorder_rows, revenue
from shelfwise.schemas import REORDER_DAYS


def _rate() -> Column:
    return percent(F.count_if(is_reorder()), F.count(F.lit(1)))


def stores_most_at_risk(gold: DataFrame) -> DataFrame:
    """Which stores have the most SKUs at risk?"""
    return (
        reorder_rows(gold).groupBy("store_id").agg(F.count(F.lit(1)).alias("skus_at_risk"))
        .orderBy(F.desc("skus_at_risk"), "store_id")
    )


def top_skus_low_supply(gold: DataFrame, days: float = REORDER_DAYS, k: int = 10) -> DataFrame:
    """Which SKUs are short of ``days`` of supply in most stores?"""
    rows = gold.where(F.col("days_of_supply") < days).groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("stores"), F.min("days_of_supply").alias("min_days_of_supply"))
    return top_k(rows, k, F.desc("stores"), "sku_id")


def region_stores_to_order(gold: DataFrame, stores: DataFrame, region: str) -> DataFrame:
    """Which stores of a region need an order?"""
    local = stores.where(F.col("region") == region)
    return (
        with_stores(reorder_rows(gold), local).select("store_id", "store_name").distinct()
        .orderBy("store_id")
    )


def avg_days_supply(gold: DataFrame) -> DataFrame:
    """What is the average days of supply? Unknown values are skipped."""
    return gold.agg(F.round(exact_mean(F.col("days_of_supply")), 1).alias("avg_days_of_supply"))


def zero_inventory_stores(gold: DataFrame) -> DataFrame:
    """Which stores have an empty shelf for any SKU?"""
    return gold.where(F.col("inventory_on_hand") == 0).select("store_id").distinct().orderBy("store_id")


def stockout_rate(gold: DataFrame) -> DataFrame:
    """What share of all pairs must reorder?"""
    return gold.agg(_rate().alias("stockout_rate_pct"))


def worst_category(gold: DataFrame, skus: DataFrame) -> DataFrame:
    """Which category has the highest stockout rate?"""
    share = F.count_if(is_reorder()) / F.count(F.lit(1))
    rows = with_skus(gold, skus).groupBy("category").agg(
        share.alias("_share"), _rate().alias("stockout_rate_pct"))
    return top_k(rows, 1, F.desc("_share"), "category").drop("_share")


def reorder_store_count(gold: DataFrame) -> DataFrame:
    """How many stores must reorder something?"""
    return reorder_rows(gold).agg(F.count_distinct("store_id").alias("stores"))


def worst_region(gold: DataFrame, stores: DataFrame) -> DataFrame:
    """Which region has most stores that must reorder?"""
    rows = with_stores(reorder_rows(gold), stores).groupBy("region").agg(
        F.count_distinct("store_id").alias("stores"))
    return top_k(rows, 1, F.desc("stores"), "region")


def compare_regions(gold: DataFrame, stores: DataFrame, regions: tuple[str, str]) -> DataFrame:
    """How do two regions' stockout rates compare?"""
    local = stores.where(F.col("region").isin(*regions))
    return (
        with_stores(gold, local).groupBy("region").agg(_rate().alias("stockout_rate_pct"))
        .orderBy("region")
    )


def state_low_supply(
    gold: DataFrame, stores: DataFrame, state: str, days: float = REORDER_DAYS
) -> DataFrame:
    """How many stores of a state are below ``days`` of supply?"""
    local = stores.where(F.col("state") == state)
    return with_stores(gold.where(F.col("days_of_supply") < days), local).agg(
        F.count_distinct("store_id").alias("stores"))


def region_top_stores_revenue(
    gold: DataFrame, stores: DataFrame, skus: DataFrame, region: str, k: int = 5
) -> DataFrame:
    """Which stores of a region have most revenue at risk?"""
    local = stores.where(F.col("region") == region)
    rows = with_dimensions(reorder_rows(gold), local, skus).groupBy("store_id", "store_name").agg(
        exact_sum(revenue()).alias("_value"))
    return top_k(rows, k, F.desc("_value"), "store_id").select(
        "store_id", "store_name", F.round("_value", 0).alias("weekly_revenue_at_risk"))


def tracked_combos(gold: DataFrame) -> DataFrame:
    """How many pairs are tracked?"""
    return gold.agg(F.count(F.lit(1)).alias("store_sku_combos"))


def store_last_signal(gold: DataFrame, store_id: int) -> DataFrame:
    """When was a store's last signal?"""
    return gold.where(F.col("store_id") == store_id).agg(
        F.max("signal_date").alias("last_signal_date"))


def top_demand_skus(gold: DataFrame) -> DataFrame:
    """Which SKUs sell most per day, over all stores?"""
    return (
        gold.groupBy("sku_id")
        .agg(exact_mean(F.col("avg_daily_demand_7d")).alias("avg_daily_demand"))
        .orderBy(F.desc("avg_daily_demand"), "sku_id")
    )
