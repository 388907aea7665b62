"""Invariants and edge cases of the KPI layer."""

import pytest
from pyspark.sql import functions as F

from helpers import dims, pos_frame, random_sales, rows_of, sale
from shelfwise import functions as fn
from shelfwise.functions.labels import DESK_BANDS, WEB_BANDS
from shelfwise.operators import date_spine, observe_rules, rule_report
from shelfwise.plans import gold, kpis, orders, questions, signal_history, silver, snapshot


@pytest.fixture(scope="module")
def world(spark):
    rows = silver(pos_frame(spark, random_sales(5, n=900)))
    stores, skus = dims(spark, range(4), range(5))
    return gold(rows, latest="per_key").persist(), stores, skus


def test_status_counts_sum_to_gold(world):
    signals, _, _ = world
    counts = kpis.status_distribution(signals).agg(F.sum("store_sku_combos")).first()[0]
    assert counts == signals.count() == 20


def test_pivot_equals_breakdown(world):
    signals, stores, _ = world
    pivot = {(r["region"], s): r[s] for r in kpis.regional_pivot(signals, stores).collect()
             for s in ["REORDER NOW", "WATCH", "OK"] if r[s]}
    flat = {(r.region, r.replenishment_status): r.combos
            for r in kpis.regional_breakdown(signals, stores).collect()}
    assert pivot == flat


def test_pivot_fills_missing_statuses_with_zero(spark):
    stores, _ = dims(spark)
    signals = gold(silver(pos_frame(spark, [sale(1, 1, 0, 10, stock=0)])))
    assert kpis.regional_pivot(signals, stores).first().asDict() == {
        "region": "north", "REORDER NOW": 1, "WATCH": 0, "OK": 0}


def test_empty_gold_summary_is_zero(spark):
    _, skus = dims(spark)
    summary = kpis.kpi_summary(gold(silver(pos_frame(spark, []))), skus).first().asDict()
    assert set(summary.values()) == {0}


def test_summary_agrees_with_single_kpis(world):
    signals, _, skus = world
    summary = kpis.kpi_summary(signals, skus).first()
    assert summary.revenue_at_risk == int(kpis.revenue_at_risk(signals, skus).first()[0])
    assert summary.stockout_rate_pct == questions.stockout_rate(signals).first()[0]
    assert (summary.total_stores, summary.total_skus) == tuple(kpis.coverage_counts(signals).first())


def test_revenue_uses_the_rounded_demand(spark):
    _, skus = dims(spark)
    rows = silver(pos_frame(spark, [sale(1, 1, 0, 1), sale(1, 1, 1, 1), sale(1, 1, 2, 2, stock=0)]))
    assert kpis.revenue_at_risk(gold(rows), skus).first()[0] == round(1.3 * 2.5 * 7)


def test_orphans_are_dropped_by_joins_but_stay_in_gold_and_orders(spark):
    stores, skus = dims(spark, [1], [1])
    signals = gold(silver(pos_frame(spark, [sale(1, 1, 0, 9, 0), sale(9, 1, 0, 9, 0), sale(1, 9, 0, 9, 0)])))
    assert signals.count() == 3
    assert kpis.top_alerts(signals, stores, skus).count() == 1
    assert kpis.kpi_summary(signals, skus).first().reorder_now_count == 3
    lines = orders.purchase_order_lines(signals, stores, skus)
    assert lines.count() == 3 and lines.where("body IS NULL OR subject IS NULL").isEmpty()


def test_alert_ties_go_by_store_and_sku(spark):
    stores, skus = dims(spark)
    signals = gold(silver(pos_frame(spark, [sale(s, k, 0, 9, 0) for s in (2, 1) for k in (2, 1)])))
    rows = kpis.top_alerts(signals, stores, skus, 3).select("store_id", "sku_id").collect()
    assert [tuple(r) for r in rows] == [(1, 1), (1, 2), (2, 1)]


def test_order_text(spark):
    stores, skus = dims(spark)
    signals = gold(silver(pos_frame(spark, [sale(1, 2, 0, 10, stock=5)])))
    line = orders.purchase_order_lines(signals, stores, skus).first()
    assert line.order_key == "2024-01-01|1|2"
    assert line.subject == "Replenish SKU 2 at store 1"
    assert line.body == "Please deliver to store 1 (north) more of SKU 2 (dairy).\nOn hand: 5; lasts 0.5 days at 10.0 sold a day."


def test_orders_are_idempotent_per_date(spark, tmp_path):
    stores, skus = dims(spark)
    path = str(tmp_path / "orders")
    rows = silver(pos_frame(spark, [sale(1, 1, 0, 9, 0), sale(1, 1, 1, 9, 0), sale(2, 2, 1, 9, 0)]))
    for n in (0, 1, 1):
        day = F.date_add(F.lit("2024-01-01").cast("date"), n)
        history = signal_history(rows).where(F.col("signal_date") == day)
        orders.write_orders(orders.purchase_order_lines(history, stores, skus), path)
    assert spark.read.parquet(path).count() == 3


def test_trend_keeps_the_last_days(spark):
    _, skus = dims(spark)
    history = signal_history(silver(pos_frame(spark, [sale(1, 1, n, 9, 0) for n in range(40)])))
    assert kpis.status_trend(history, skus).count() == 30
    assert kpis.status_trend(history, skus, days=None).count() == 40


def test_snapshot_agrees_with_the_kpis(world):
    signals, stores, skus = world
    values = {(r.metric, r.dim): r.value for r in snapshot.kpi_snapshot(signals, stores, skus).collect()}
    for row in kpis.regional_breakdown(signals, stores).collect():
        assert values["region_combos", f"{row.region}|{row.replenishment_status}"] == row.combos
    for row in kpis.category_risk(signals, skus).collect():
        assert values["category_at_risk", row.category] == row.stores_at_risk
        assert values["category_avg_days_supply", row.category] == row.avg_days_supply
    assert values["tracked_combos", "all"] == 20


def test_quality_counts_and_keeps_bad_rows(spark):
    from pyspark.sql import Observation
    pos = pos_frame(spark, [sale(1, 1, 0, -1, -1), sale(1, 1, 1, 5, None), sale(1, 1, 2, 5, 5)])
    rows = silver(pos)
    assert rows_of(rule_report(rows)) == [("valid_inventory", 1, 2), ("valid_qty", 2, 1)]
    seen = Observation()
    assert observe_rules(rows, seen).count() == 3
    assert seen.get == {"rows": 3, "valid_qty": 1, "valid_inventory": 2}


def test_quality_of_nothing(spark):
    assert rows_of(rule_report(pos_frame(spark, []))) == [("valid_inventory", 0, 0), ("valid_qty", 0, 0)]


def test_labels(spark):
    row = spark.range(123456, 123457).select(
        fn.padded_id("S", F.col("id"), 3).alias("long"),
        fn.padded_id("S", F.lit(7), 3).alias("short"),
        fn.round_robin(F.col("id"), ["a", "b", "c"]).alias("label"),
        fn.urgency_band(F.lit(None).cast("double"), *WEB_BANDS).alias("unknown"),
        fn.urgency_band(F.lit(1.0), *WEB_BANDS).alias("one"),
        fn.urgency_band(F.lit(2.0), *DESK_BANDS).alias("two"),
        fn.urgency_band(F.lit(4.0), *DESK_BANDS).alias("four"),
    ).first()
    assert tuple(row) == ("S123456", "S007", "a", "critical", "high", "high", "normal")


def test_date_spine_of_nothing_is_empty(spark):
    assert date_spine(pos_frame(spark, [])).isEmpty()


def test_orders_for_chosen_pairs(spark, world):
    signals, stores, skus = world
    chosen = signals.orderBy("store_id", "sku_id").limit(2).select("store_id", "sku_id")
    lines = orders.purchase_order_lines(signals, stores, skus, chosen)
    assert rows_of(lines, "store_id", "sku_id") == rows_of(chosen, "store_id", "sku_id")
