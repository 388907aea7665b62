"""KPI queries over gold and the two dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.functions import at_risk_value, exact_mean, exact_sum, percent
from shelfwise.operators import latest_date, top_k, with_dimensions, with_skus, with_stores
from shelfwise.schemas import BRONZE, GOLD, OK, REORDER_NOW, SILVER, STATUSES, WATCH



def _most_urgent_first() -> list[Column]:
    """Total order: ties in days of supply go by store and SKU."""
    return [F.asc_nulls_last("days_of_supply"), F.asc("store_id"), F.asc("sku_id")]


def is_reorder() -> Column:
    return F.col("replenishment_status") == REORDER_NOW


def revenue() -> Column:
    return at_risk_value(F.col("avg_daily_demand_7d"), F.col("avg_unit_price"))


def reorder_rows(gold: DataFrame) -> DataFrame:
    return gold.where(is_reorder())


def status_distribution(gold: DataFrame) -> DataFrame:
    """Rows and share per status. The unpartitioned window sees at most three rows."""
    counts = gold.groupBy("replenishment_status").agg(F.count(F.lit(1)).alias("store_sku_combos"))
    total = F.sum("store_sku_combos").over(Window.partitionBy())
    return counts.withColumn("pct_of_total", percent(F.col("store_sku_combos"), total)).orderBy(
        F.desc("store_sku_combos"), "replenishment_status")


def category_risk(gold: DataFrame, skus: DataFrame, with_price: bool = True) -> DataFrame:
    """Reorder rows per category. ``stores_at_risk`` counts store and SKU rows."""
    measures = [
        F.count(F.lit(1)).alias("stores_at_risk"),
        F.round(exact_mean(F.col("days_of_supply")), 1).alias("avg_days_supply"),
    ]
    if with_price:
        measures.append(F.round(exact_mean(F.col("avg_unit_price")), 2).alias("unit_price"))
    return (
        with_skus(reorder_rows(gold), skus).groupBy("category").agg(*measures)
        .orderBy(F.desc("stores_at_risk"), "category")
    )


def regional_breakdown(gold: DataFrame, stores: DataFrame) -> DataFrame:
    return (
        with_stores(gold, stores).groupBy("region", "replenishment_status")
        .agg(F.count(F.lit(1)).alias("combos")).orderBy("region", "replenishment_status")
    )


def regional_pivot(gold: DataFrame, stores: DataFrame) -> DataFrame:
    """One column per status, 0 where a region has none. Given values spare the discovery job."""
    return (
        with_stores(gold, stores).groupBy("region")
        .pivot("replenishment_status", STATUSES).agg(F.count(F.lit(1)))
        .na.fill(0, STATUSES).orderBy("region")
    )


def revenue_at_risk(gold: DataFrame, skus: DataFrame) -> DataFrame:
    return with_skus(reorder_rows(gold), skus).agg(
        F.round(exact_sum(revenue()), 0).alias("weekly_revenue_at_risk"))


def top_alerts(gold: DataFrame, stores: DataFrame, skus: DataFrame, k: int = 10) -> DataFrame:
    """The k most urgent reorder rows with both dimensions."""
    rows = with_dimensions(reorder_rows(gold), stores, skus).select(
        "region", "store_id", "category", "sku_id",
        "days_of_supply", "inventory_on_hand", "avg_daily_demand_7d",
    )
    return top_k(rows, k, *_most_urgent_first())


def top_alerts_plain(gold: DataFrame, k: int = 50) -> DataFrame:
    """The k most urgent reorder rows without dimensions."""
    rows = reorder_rows(gold).select(
        "store_id", "sku_id", "inventory_on_hand",
        "days_of_supply", "avg_daily_demand_7d", "replenishment_status",
    )
    return top_k(rows, k, *_most_urgent_first())


def sku_risk(gold: DataFrame, skus: DataFrame, k: int = 20) -> DataFrame:
    """SKUs that are at risk in most stores."""
    rows = with_skus(reorder_rows(gold), skus).groupBy("category", "sku_id").agg(
        F.count(F.lit(1)).alias("stores_at_risk"),
        F.round(exact_mean(F.col("days_of_supply")), 1).alias("avg_days_supply"),
    )
    return top_k(rows, k, F.desc("stores_at_risk"), "sku_id")


def coverage_counts(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.count_distinct("store_id").alias("stores"), F.count_distinct("sku_id").alias("skus"))


def last_signal_date(gold: DataFrame) -> DataFrame:
    return gold.agg(F.max("signal_date").alias("last_updated"))


def kpi_summary(gold: DataFrame, skus: DataFrame) -> DataFrame:
    """One row, one pass; zeros for an empty gold.

    The outer join keeps signals of unlisted SKUs in the counts; having no
    price they add nothing to the revenue, just as with an inner join.
    """
    rows = F.count(F.lit(1))
    count_of = {status: F.count_if(F.col("replenishment_status") == status) for status in STATUSES}

    def share(status: str) -> Column:
        return F.coalesce(percent(count_of[status], rows), F.lit(0.0))

    value = exact_sum(F.when(is_reorder(), revenue()))
    return with_skus(gold, skus, "left").agg(
        share(REORDER_NOW).alias("stockout_rate_pct"),
        F.coalesce(F.round(value, 0), F.lit(0.0)).cast("bigint").alias("revenue_at_risk"),
        F.count_distinct("store_id").alias("total_stores"),
        F.count_distinct("sku_id").alias("total_skus"),
        count_of[REORDER_NOW].alias("reorder_now_count"),
        count_of[WATCH].alias("watch_count"),
        count_of[OK].alias("ok_count"),
        share(REORDER_NOW).alias("reorder_now_pct"),
        share(WATCH).alias("watch_pct"),
        share(OK).alias("ok_pct"),
    )


def platform_stats(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Row count per layer, and the last signal date, in one job."""
    layers = [(BRONZE, "Bronze", bronze), (SILVER, "Silver", silver), (GOLD, "Gold", gold)]
    counts = None
    for table, layer, df in layers:
        count = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "rows")
        counts = count if counts is None else counts.unionByName(count)
    return counts.withColumn("last_updated", latest_date(gold, "signal_date"))


def platform_total(stats: DataFrame) -> DataFrame:
    return stats.agg(F.sum("rows").alias("total_records"))


def status_trend(history: DataFrame, skus: DataFrame, days: int | None = 30) -> DataFrame:
    """Stockout rate and revenue at risk by date, over the last ``days`` dates."""
    if days:
        last = latest_date(history, "signal_date")
        history = history.where(F.col("signal_date") > F.date_sub(last, days))
    rows, reorder = F.count(F.lit(1)), F.count_if(is_reorder())
    value = exact_sum(F.when(is_reorder(), revenue()))
    return (
        with_skus(history, skus, "left").groupBy("signal_date")
        .agg(
            rows.alias("store_sku_combos"),
            reorder.alias("reorder_now"),
            percent(reorder, rows).alias("stockout_rate_pct"),
            F.coalesce(F.round(value, 0), F.lit(0.0)).alias("weekly_revenue_at_risk"),
        )
        .orderBy("signal_date")
    )
