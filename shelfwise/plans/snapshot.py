"""All KPIs as ``(metric, dim, value, signal_date)``, computed once per run for readers."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from shelfwise.functions import exact_mean, exact_sum, percent
from shelfwise.operators import latest_date, with_dimensions
from shelfwise.plans.kpis import coverage_counts, is_reorder, revenue, top_alerts


def kpi_snapshot(
    gold: DataFrame, stores: DataFrame, skus: DataFrame, layers: DataFrame | None = None,
    *, alerts: int = 25, valid_for: str = "1 hour",
) -> DataFrame:
    """Every KPI from one joined pass with grouping sets, plus coverage, top alerts and layer counts.

    Coverage stays apart: distinct counts inside grouping sets would multiply
    the rows once per distinct column and once more per set. ``layers`` is the result of
    :func:`platform_stats`, left out where it is not given. ``computed_at`` and ``valid_until``
    tell readers when to ask for a new snapshot.
    """
    rows = F.count(F.lit(1))
    sets = [["replenishment_status"], ["region", "replenishment_status"], ["category"], []]
    totals = (
        with_dimensions(gold, stores, skus, "left")
        .groupingSets(sets, "region", "category", "replenishment_status")
        .agg(
            F.grouping_id("region", "category", "replenishment_status").alias("_set"),
            rows.cast("double").alias("rows"),
            F.count_if(is_reorder()).cast("double").alias("reorder"),
            percent(F.count_if(is_reorder()), rows).alias("rate"),
            F.round(exact_mean(F.when(is_reorder(), F.col("days_of_supply"))), 1).alias("days"),
            F.coalesce(F.round(exact_sum(F.when(is_reorder(), revenue())), 0), F.lit(0.0)).alias("value"),
        )
    )
    # One bit per grouping column, set where the column is rolled up.
    by_status, by_region, by_category, overall = 0b110, 0b010, 0b101, 0b111

    def line(metric: str, dim, value: str):
        return F.struct(F.lit(metric).alias("metric"), dim.alias("dim"), F.col(value).alias("value"))

    everything = F.lit("all")
    status, region, category = F.col("replenishment_status"), F.col("region"), F.col("category")
    lines = (
        F.when(F.col("_set") == overall, F.array(
            line("tracked_combos", everything, "rows"),
            line("stockout_rate_pct", everything, "rate"),
            line("weekly_revenue_at_risk", everything, "value"),
        ))
        .when(F.col("_set") == by_status, F.array(line("status_combos", status, "rows")))
        .when((F.col("_set") == by_region) & region.isNotNull(), F.array(
            line("region_combos", F.concat_ws("|", region, status), "rows")))
        .when((F.col("_set") == by_category) & category.isNotNull() & (F.col("reorder") > 0), F.array(
            line("category_at_risk", category, "reorder"),
            line("category_avg_days_supply", category, "days"),
        ))
    )
    measured = totals.select(F.inline(lines))
    coverage = coverage_counts(gold).select(F.inline(F.array(*[
        F.struct(F.lit(metric).alias("metric"), everything.alias("dim"),
                 F.col(column).cast("double").alias("value"))
        for metric, column in [("stores_covered", "stores"), ("skus_covered", "skus")]
    ])))
    alert = F.concat_ws("|", "region", "store_id", "category", "sku_id")
    urgent = top_alerts(gold, stores, skus, alerts).select(F.inline(F.array(*[
        F.struct(F.lit(metric).alias("metric"), alert.alias("dim"),
                 F.col(column).cast("double").alias("value"))
        for metric, column in [("alert_days_of_supply", "days_of_supply"),
                               ("alert_inventory", "inventory_on_hand"),
                               ("alert_avg_demand_7d", "avg_daily_demand_7d")]
    ])))
    parts = measured.unionByName(coverage).unionByName(urgent)
    if layers is not None:
        parts = parts.unionByName(layers.select(
            F.lit("layer_rows").alias("metric"), F.col("layer").alias("dim"),
            F.col("rows").cast("double").alias("value")))
    now = F.current_timestamp()
    return parts.select(
        "*", latest_date(gold, "signal_date").alias("signal_date"),
        now.alias("computed_at"), (now + F.expr(f"INTERVAL {valid_for}")).alias("valid_until"))


def snapshot_changes(snapshot: DataFrame, before: DataFrame) -> DataFrame:
    """``metric, dim, value, removed``: the lines in which a snapshot differs from the one ``before`` it.

    A line that is new or has another value comes with it; one that is gone comes as removed, without a value.
    """
    now = snapshot.select("metric", "dim", "value", F.lit(True).alias("_now"))
    then = before.select("metric", "dim", F.col("value").alias("_value"), F.lit(True).alias("_then"))
    differs = F.col("_now").isNull() | F.col("_then").isNull() | ~F.col("value").eqNullSafe(F.col("_value"))
    return now.join(then, ["metric", "dim"], "full").where(differs).select(
        "metric", "dim", "value", F.col("_now").isNull().alias("removed"))


def snapshot_as_of(changes: DataFrame, date: datetime.date | None = None) -> DataFrame:
    """``metric, dim, value, changed_on``: the snapshot as it was served for ``date``, by default the newest.

    ``changes`` are those of all signal dates; of each line the last change up to ``date`` counts.
    """
    if date is not None:
        changes = changes.where(F.col("signal_date") <= F.lit(date))
    last = changes.groupBy("metric", "dim").agg(
        F.max(F.struct("signal_date", "value", "removed")).alias("_last"))
    return last.where(~F.col("_last.removed")).select(
        "metric", "dim", F.col("_last.value").alias("value"), F.col("_last.signal_date").alias("changed_on"))
