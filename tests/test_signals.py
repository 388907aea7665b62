"""Boundary rules of dedup, rolling means, ratio, status and latest date."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import brute_signals, day, pos_frame, random_sales, rows_of, sale
from shelfwise import functions as fn
from shelfwise.operators import dedup, dense_daily, panel_spine, rolling_mean
from shelfwise.plans import gold, signals, silver


def rated(spark, pairs, **rules):
    rows = spark.createDataFrame(
        [(1, i, day(0), 0, 1.0, stock, demand, demand) for i, (stock, demand) in enumerate(pairs)],
        "store_id bigint, sku_id bigint, transaction_date date, qty_sold int, unit_price double, "
        "inventory_on_hand int, avg_daily_demand_7d double, avg_daily_demand_14d double")
    return [r.replenishment_status for r in signals(rows, **rules).orderBy("sku_id").collect()]


def test_status_boundaries(spark):
    pairs = [(0, 4.0), (11, 4.0), (12, 4.0), (27, 4.0), (28, 4.0)]
    assert rated(spark, pairs) == ["REORDER NOW", "REORDER NOW", "WATCH", "WATCH", "OK"]


def test_status_thresholds_are_parameters(spark):
    assert rated(spark, [(11, 4.0), (12, 4.0)], reorder_days=2, watch_days=3) == ["WATCH", "OK"]


def test_zero_demand(spark):
    pairs = [(0, 0.0), (5, 0.0), (None, 0.0)]
    assert rated(spark, pairs) == ["OK", "OK", "OK"]
    assert rated(spark, pairs, zero_demand_policy="reorder_if_empty") == ["REORDER NOW", "OK", "OK"]
    with pytest.raises(ValueError):
        fn.status(F.lit(1.0), zero_demand_policy="other")


def test_null_inventory_is_ok(spark):
    assert rated(spark, [(None, 4.0)]) == ["OK"]


def test_status_uses_the_unrounded_ratio(spark):
    rows = silver(pos_frame(spark, [sale(1, 1, 0, 100, stock=299)]))
    row = gold(rows).first()
    assert (row.days_of_supply, row.replenishment_status) == (3.0, "REORDER NOW")


def test_partial_frames(spark):
    rows = silver(pos_frame(spark, [sale(1, 1, i, q) for i, q in enumerate([10, 20, 60])]))
    assert [r[1] for r in rows_of(rows, "transaction_date", "avg_daily_demand_7d")] == [10.0, 15.0, 30.0]


def test_long_frame(spark):
    rows = silver(pos_frame(spark, [sale(1, 1, i, i + 1) for i in range(15)]))
    last = rows.orderBy(F.desc("transaction_date")).first()
    assert (last.avg_daily_demand_7d, last.avg_daily_demand_14d) == (12.0, 8.5)


def test_row_frames_span_gaps_but_dense_frames_do_not(spark):
    pos = pos_frame(spark, [sale(1, 1, 7 * i, 7) for i in range(7)])
    assert silver(pos).orderBy(F.desc("transaction_date")).first().avg_daily_demand_7d == 7.0
    dense = dense_daily(dedup(pos)).withColumn("mean", rolling_mean("qty_sold", 7))
    assert dense.orderBy(F.desc("transaction_date")).first()["mean"] == 1.0


def test_dense_panel_covers_every_pair_and_day(spark):
    pos = pos_frame(spark, random_sales(3))
    dense = dense_daily(dedup(pos))
    keys = ["store_id", "sku_id", "transaction_date"]
    assert rows_of(dense, *keys) == rows_of(panel_spine(pos), *keys)
    kept = dense.where("NOT is_gap").select("store_id", "sku_id", "transaction_date", "qty_sold",
                                            "unit_price", "inventory_on_hand")
    assert rows_of(kept) == rows_of(dedup(pos))
    assert dense.where("is_gap AND (qty_sold <> 0 OR inventory_on_hand IS NOT NULL)").isEmpty()


def test_latest_global_and_per_key(spark):
    rows = silver(pos_frame(spark, [sale(1, 1, 0, 5), sale(1, 1, 3, 5), sale(2, 1, 2, 5)]))
    assert rows_of(gold(rows), "store_id", "signal_date") == [(1, day(3))]
    assert rows_of(gold(rows, latest="per_key"), "store_id", "signal_date") == [(1, day(3)), (2, day(2))]
    assert rows_of(gold(rows, as_of=day(2)), "store_id", "signal_date") == [(2, day(2))]
    with pytest.raises(ValueError):
        gold(rows, latest="newest")


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("colocate", [False, True])
def test_signals_equal_brute_force(spark, seed, colocate):
    sales = random_sales(seed)
    expected = brute_signals(sales)
    rows = silver(pos_frame(spark, sales), colocate=colocate).withColumn(
        "ratio", fn.days_of_supply(F.col("inventory_on_hand"), F.col("avg_daily_demand_7d")))
    got = {
        (r.store_id, r.sku_id, r.transaction_date):
        (r.inventory_on_hand, r.avg_daily_demand_7d, r.avg_daily_demand_14d, r.ratio)
        for r in rows.collect()
    }
    assert got == {key: value[:4] for key, value in expected.items()}
    statuses = {
        (r.store_id, r.sku_id, r.signal_date): r.replenishment_status for r in signals(rows).collect()}
    assert statuses == {key: value[4] for key, value in expected.items()}


def test_input_order_does_not_matter(spark):
    sales = random_sales(11)
    shuffled = list(sales)
    random.Random(1).shuffle(shuffled)
    one = silver(pos_frame(spark, sales).repartition(5))
    two = silver(pos_frame(spark, shuffled).repartition(3))
    assert rows_of(one) == rows_of(two)


def test_hot_cell_leaves_one_row(spark):
    hot = spark.range(30000).selectExpr(
        "1L AS store_id", "1L AS sku_id", "DATE'2024-01-01' AS transaction_date",
        "CAST(id AS INT) AS qty_sold", "1.0D AS unit_price", "CAST(7 AS INT) AS inventory_on_hand")
    pos = hot.repartition(16).unionByName(pos_frame(spark, [sale(1, 1, 1, 4), sale(2, 2, 0, 3)]))
    assert rows_of(dedup(pos), "store_id", "transaction_date", "qty_sold") == [
        (1, day(0), 0), (1, day(1), 4), (2, day(0), 3)]


def test_empty_input(spark):
    rows = silver(pos_frame(spark, []))
    assert rows.isEmpty() and gold(rows).isEmpty() and gold(rows, latest="per_key").isEmpty()
