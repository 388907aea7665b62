
from __future__ import annotations

import datetime
import functools
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_queries import ORACLE  # noqa: E402
from shelfwise import functions as fn, operators as op  # noqa: E402
from shelfwise.functions.labels import CATEGORIES, REGIONS  # noqa: E402
from shelfwise.plans import daily, kpis, layers, orders, questions, refresh, snapshot  # noqa: E402
from shelfwise.schemas import BRONZE, CELL, GOLD, SILVER, PAIR_KEYS  # noqa: E402
from shelfwise.session import run_folder  # noqa: E402
from shelfwise.sources import Versions, create_database, pos_from_rows, read_table, testdata as td  # noqa: E402
from shelfwise.streaming import (  # noqa: E402
    CellStore, LiveSignals, WindowStore, ingest, pane_windows, run_available,
)

try:
    import corpus_pipeline
    from shelfwise.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # The package and the pipeline may have been taken out; anything else missing is an error.
    if missing.name not in ("corpus_pipeline", "shelfwise.llm"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the named questions.
REGION, OTHER_REGION, STATE, STORE = "AMERICA", "EUROPE", "NATION_18", 1

# Last dates of the first two of three landings.
WAVE_ENDS = datetime.date(2024, 1, 14), datetime.date(2024, 1, 23)
# Store and SKU of orders by hand: whatever their status, and one that has no signal.
CHOSEN_PAIRS = [(1, 1), (2, 7), (3, 12), (4, 30), (5, 49), (6, 1000000)]

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return layers.silver(td.pos(spark, folder), td.COPY_ORDER)


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return layers.signal_history(_silver(spark, folder))


def _gold(spark: SparkSession, folder: str, **options) -> DataFrame:
    return layers.gold(_silver(spark, folder), td.pos(spark, folder), **options)


def _deduped(spark: SparkSession, folder: str) -> DataFrame:
    return layers.bronze(op.dedup(td.pos(spark, folder), order_by=td.COPY_ORDER))


def _dense(spark: SparkSession, folder: str) -> DataFrame:
    return op.dense_daily(_deduped(spark, folder), td.pos(spark, folder))


def _rows(column: str) -> Query:
    return lambda spark, folder: _silver(spark, folder).select(*CELL, column)


def _supply(spark: SparkSession, folder: str) -> DataFrame:
    ratio = fn.days_of_supply(F.col("inventory_on_hand"), F.col("avg_daily_demand_7d"))
    return _silver(spark, folder).select(*CELL, "inventory_on_hand", ratio.alias("days_of_supply"))


def _status(spark: SparkSession, folder: str) -> DataFrame:
    ratio, stock = F.col("days_of_supply"), F.col("inventory_on_hand")
    return _supply(spark, folder).select(
        *CELL,
        fn.status(ratio).alias("replenishment_status"),
        fn.status(ratio, stock, zero_demand_policy="reorder_if_empty").alias("status_if_empty"),
    )


def _materialised_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Silver stored by date, then gold read back from the one partition it needs."""
    path = run_folder(spark, "silver")
    _silver(spark, folder).hint("rebalance", "transaction_date").write.partitionBy(
        "transaction_date").parquet(path)
    return layers.gold(spark.read.parquet(path))


def _extended_tables(spark: SparkSession, folder: str, **options) -> Versions:
    """Stored tables of the files that land first, then extended twice by what landed since."""
    database = f"run_{uuid.uuid4().hex}"
    create_database(spark, database, run_folder(spark, "database"))
    landing = run_folder(spark, "landing")
    pos, stores, skus = td.pos(spark, folder), td.stores(spark, folder), td.skus(spark, folder)
    day, (first, second) = F.col("transaction_date"), WAVE_ENDS
    waves = [day <= F.lit(first), (day > F.lit(first)) & (day <= F.lit(second)), day > F.lit(second)]
    refreshes = [functools.partial(refresh.run, **options), refresh.extend, refresh.extend]
    for wave, step in zip(waves, refreshes):
        pos.where(wave).write.mode("append").option("compression", "zstd").parquet(landing)
        tables = step(spark, database, spark.read.parquet(landing), stores, skus, landing=landing, order_by=td.COPY_ORDER)
    return tables


def _extended(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    tables = _extended_tables(spark, folder)
    return lambda table: spark.table(tables.name(table))


def _extended_panel(spark: SparkSession, folder: str) -> DataFrame:
    return refresh.panel(_extended_tables(spark, folder, with_panel=True))


def _extended_load_times(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by date, and those with a load time that is not in the future."""
    tables = _extended_tables(spark, folder)
    rows = read_table(spark, tables.name(SILVER), ["transaction_date", "load_timestamp"])
    return rows.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("load_timestamp") <= F.current_timestamp()).alias("stamped"))


def _snapshot_history(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshots as they were served after each of the three refreshes, from the stored changes."""
    changes = _extended(spark, folder)(refresh.CHANGES)
    dates = [*WAVE_ENDS, None]
    served = [snapshot.snapshot_as_of(changes, date).select(F.lit(n).alias("refresh"), "metric", "dim", "value")
              for n, date in enumerate(dates)]
    return functools.reduce(DataFrame.unionByName, served)


def _extended_trend(spark: SparkSession, folder: str) -> DataFrame:
    return daily.trend_of(_extended(spark, folder)(refresh.DAILY))


def _extended_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct stores and SKUs over all dates and over the last seven, merged from the dates' bitmaps."""
    stored = _extended(spark, folder)(refresh.COVERAGE)
    recent = stored.where(F.col("signal_date") > F.date_sub(op.latest_date(stored, "signal_date"), 7))
    return daily.coverage_of(stored).withColumn("span", F.lit("all")).unionByName(
        daily.coverage_of(recent).withColumn("span", F.lit("last_7")))


def _extended_stats(spark: SparkSession, folder: str) -> DataFrame:
    stored = _extended(spark, folder)
    return kpis.platform_stats(stored(BRONZE), stored(SILVER), stored(GOLD))


def _stored_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the last signal date; those of the earlier refreshes stay stored beside them."""
    stored = _extended(spark, folder)
    return stored(refresh.ORDERS).where(F.col("signal_date") == op.latest_date(stored(GOLD), "signal_date"))


def _snapshot(spark: SparkSession, folder: str) -> DataFrame:
    rows = snapshot.kpi_snapshot(
        _gold(spark, folder), td.stores(spark, folder), td.skus(spark, folder), _platform(spark, folder))
    return rows.drop("computed_at", "valid_until")


def _platform(spark: SparkSession, folder: str) -> DataFrame:
    pos = td.pos(spark, folder)
    return kpis.platform_stats(pos, _silver(spark, folder), _gold(spark, folder))


def _chosen_orders(spark: SparkSession, folder: str) -> DataFrame:
    pairs = pos_from_rows(spark, CHOSEN_PAIRS, PAIR_KEYS)
    return orders.purchase_order_lines(
        _gold(spark, folder, latest="per_key"), td.stores(spark, folder), td.skus(spark, folder), pairs)


def _silver_by_part(spark: SparkSession, folder: str) -> DataFrame:
    return layers.silver(td.pos_by_part(spark, folder), td.COPY_ORDER)


def _gold_by_part(spark: SparkSession, folder: str, **options) -> DataFrame:
    return layers.gold(_silver_by_part(spark, folder), td.pos_by_part(spark, folder), **options)


def _trend_by_part(spark: SparkSession, folder: str) -> DataFrame:
    """30 of 90 dates; a signal of an unknown SKU counts, at no value."""
    history = layers.signal_history(_silver_by_part(spark, folder))
    return kpis.status_trend(history, td.skus_by_part(spark, folder))


def _dow(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("transaction_date")
    return (
        _deduped(spark, folder)
        .select(*CELL, "qty_sold", fn.day_of_week(day).alias("day_of_week"),
                fn.dow_factor(day).alias("demand_factor"))
        .withColumn("qty_adjusted", F.col("qty_sold") / F.col("demand_factor"))
    )


def _keys(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    store = td.load(spark, folder, "supplier").select(F.col("s_suppkey").cast("bigint").alias("key"))
    sku = td.load(spark, folder, "part").select(F.col("p_partkey").cast("bigint").alias("key"))
    return store, sku


def _padded(spark: SparkSession, folder: str) -> DataFrame:
    store, sku = _keys(spark, folder)
    key = F.col("key")
    return store.withColumn("label", fn.padded_id("STORE_", key, 4)).unionByName(
        sku.withColumn("label", fn.padded_id("SKU_", key, 4)))


def _round_robin(spark: SparkSession, folder: str) -> DataFrame:
    store, sku = _keys(spark, folder)
    key = F.col("key")
    return store.select(F.lit("store").alias("kind"), "key", fn.round_robin(key, REGIONS).alias("label")).unionByName(
        sku.select(F.lit("sku").alias("kind"), "key", fn.round_robin(key, CATEGORIES).alias("label")))


def _dense_rolling(spark: SparkSession, folder: str) -> DataFrame:
    return _dense(spark, folder).select(
        *CELL, "is_gap",
        op.rolling_mean("qty_sold", 7).alias("avg_daily_demand_7d"),
        op.rolling_mean("qty_sold", 14).alias("avg_daily_demand_14d"),
    )


def _stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    root = run_folder(spark, "bronze")
    run_available(ingest(layers.bronze(td.pos_stream(spark, folder)), f"{root}/rows", f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/rows").drop("batch_id")


def _landed(spark: SparkSession, folder: str, root: str) -> Callable[[], DataFrame]:
    """All rows in twelve files of mixed dates, one micro-batch each; small row groups let tasks share a file."""
    td.load(spark, folder, "lineitem").select(*td.LINE).repartition(12).write.option(
        "parquet.block.size", 8 << 20).parquet(f"{root}/landing/lineitem.parquet")
    return lambda: td.pos_stream(spark, f"{root}/landing", max_files=1)


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    """Two merges, and two batches after them."""
    root = run_folder(spark, "cells")
    store = CellStore(spark, f"{root}/state", td.COPY_ORDER, compact_every=5)
    run_available(store.start(_landed(spark, folder, root)(), f"{root}/checkpoint"))
    return store.current()


def _stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    root = run_folder(spark, "windows")
    store = WindowStore(spark, f"{root}/state", td.COPY_ORDER, compact_every=5)
    run_available(store.start(_landed(spark, folder, root)(), f"{root}/checkpoint"))
    return store.current()


def _stream_gold(spark: SparkSession, folder: str) -> DataFrame:
    root = run_folder(spark, "live")
    stream, checkpoint = _landed(spark, folder, root), f"{root}/checkpoint"
    live = LiveSignals(spark, f"{root}/state", td.COPY_ORDER)
    for _ in range(2):  # the second run finds nothing new
        run_available(live.start(stream(), checkpoint))
    return live.current(checkpoint, latest="global")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the current replenishment signal of every store and SKU."""
    return _gold(spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """One entry per operator; each takes (spark, folder of the test tables)."""
    def over_gold(build: Callable[..., DataFrame], *dims: str, **options) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            sides = [getattr(td, name)(spark, folder) for name in dims]
            return build(_gold(spark, folder), *sides, **options)
        return run

    def by_part(build: Callable[..., DataFrame], *dims: str, **options) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            sides = [getattr(td, name)(spark, folder) for name in dims]
            return build(_gold_by_part(spark, folder), *sides, **options)
        return run

    out: dict[str, Query] = {
        # sources and dimensions
        "bronze_pos": lambda s, d: layers.bronze(td.pos(s, d)),
        "dim_stores": td.stores,
        "dim_skus": td.skus,
        # silver
        "dedup_pos": _deduped,
        "rolling_demand_7d": _rows("avg_daily_demand_7d"),
        "rolling_demand_14d": _rows("avg_daily_demand_14d"),
        "silver_signals": _silver,
        "dq_report": lambda s, d: op.rule_report(_silver(s, d)),
        # gold
        "days_of_supply": lambda s, d: _supply(s, d).drop("inventory_on_hand"),
        "replenishment_status": _status,
        "gold_signals": _gold,
        "gold_signals_per_key": lambda s, d: _gold(s, d, latest="per_key"),
        "materialised_gold": _materialised_gold,
        "signal_history": _history,
        "status_trend": lambda s, d: kpis.status_trend(_history(s, d), td.skus(s, d)),
        "reorder_rows": over_gold(kpis.reorder_rows),
        "signals_with_sku": over_gold(op.with_skus, "skus"),
        "signals_with_store": over_gold(op.with_stores, "stores"),
        # KPIs
        "status_distribution": over_gold(kpis.status_distribution),
        "category_risk": over_gold(kpis.category_risk, "skus"),
        "category_risk_api": over_gold(kpis.category_risk, "skus", with_price=False),
        "regional_breakdown": over_gold(kpis.regional_breakdown, "stores"),
        "regional_pivot": over_gold(kpis.regional_pivot, "stores"),
        "revenue_at_risk": over_gold(kpis.revenue_at_risk, "skus"),
        "top_alerts_10": over_gold(kpis.top_alerts, "stores", "skus", k=10),
        "top_alerts_25": over_gold(kpis.top_alerts, "stores", "skus", k=25),
        "top_alerts_50": over_gold(kpis.top_alerts_plain, k=50),
        "sku_risk_top20": over_gold(kpis.sku_risk, "skus", k=20),
        "coverage_counts": over_gold(kpis.coverage_counts),
        "last_signal_date": over_gold(kpis.last_signal_date),
        "platform_stats": _platform,
        "platform_total": lambda s, d: kpis.platform_total(_platform(s, d)),
        "kpi_summary": over_gold(kpis.kpi_summary, "skus"),
        "kpi_snapshot": _snapshot,
        # stored tables, extended
        "extended_silver": lambda s, d: _extended(s, d)(SILVER).drop("load_timestamp"),
        "extended_gold": lambda s, d: _extended(s, d)(GOLD),
        "extended_platform_stats": _extended_stats,
        "extended_trend": _extended_trend,
        "extended_coverage": _extended_coverage,
        "extended_gold_per_key": lambda s, d: _extended(s, d)(refresh.PER_PAIR),
        "extended_panel": _extended_panel,
        "extended_load_times": _extended_load_times,
        "snapshot_history": _snapshot_history,
        "stored_orders": _stored_orders,
        "orders_chosen_pairs": _chosen_orders,
        # every part a SKU, 90 dates, faulty rows
        "dim_skus_by_part": td.skus_by_part,
        "silver_by_part": _silver_by_part,
        "dq_report_by_part": lambda s, d: op.rule_report(_silver_by_part(s, d)),
        "gold_per_key_by_part": lambda s, d: _gold_by_part(s, d, latest="per_key"),
        "status_trend_by_part": _trend_by_part,
        "signals_with_sku_by_part": by_part(op.with_skus, "skus_by_part"),
        "category_risk_by_part": by_part(kpis.category_risk, "skus_by_part"),
        "regional_breakdown_by_part": by_part(kpis.regional_breakdown, "stores"),
        "sku_risk_top20_by_part": by_part(kpis.sku_risk, "skus_by_part", k=20),
        "top_alerts_25_by_part": by_part(kpis.top_alerts, "stores", "skus_by_part", k=25),
        "purchase_order_lines_by_part": by_part(orders.purchase_order_lines, "stores", "skus_by_part"),
        # panel and labels
        "date_spine": lambda s, d: op.date_spine(td.pos(s, d)),
        "panel_spine": lambda s, d: op.panel_spine(td.pos(s, d)),
        "dense_daily_pos": _dense,
        "dense_rolling_demand": _dense_rolling,
        "window_demand": lambda s, d: pane_windows(_deduped(s, d)),
        "dow_demand_factor": _dow,
        "padded_ids": _padded,
        "dim_round_robin": _round_robin,
        "urgency_bands": over_gold(orders.urgency_bands),
        "purchase_order_lines": over_gold(orders.purchase_order_lines, "stores", "skus"),
        # named questions
        "nl_stores_most_at_risk": over_gold(questions.stores_most_at_risk),
        "nl_top_skus_low_supply": over_gold(questions.top_skus_low_supply),
        "nl_region_stores_to_order": over_gold(questions.region_stores_to_order, "stores", region=REGION),
        "nl_avg_days_supply": over_gold(questions.avg_days_supply),
        "nl_zero_inventory_stores": over_gold(questions.zero_inventory_stores),
        "nl_stockout_rate": over_gold(questions.stockout_rate),
        "nl_worst_category": over_gold(questions.worst_category, "skus"),
        "nl_reorder_store_count": over_gold(questions.reorder_store_count),
        "nl_worst_region": over_gold(questions.worst_region, "stores"),
        "nl_compare_regions": over_gold(questions.compare_regions, "stores", regions=(REGION, OTHER_REGION)),
        "nl_state_low_supply": over_gold(questions.state_low_supply, "stores", state=STATE),
        "nl_region_top_stores_revenue": over_gold(
            questions.region_top_stores_revenue, "stores", "skus", region=REGION),
        "nl_tracked_combos": over_gold(questions.tracked_combos),
        "nl_store_last_signal": over_gold(questions.store_last_signal, store_id=STORE),
        "nl_top_demand_skus": over_gold(questions.top_demand_skus),
        # streaming
        "stream_bronze_pos": _stream_bronze,
        "stream_dedup_pos": _cells,
        "stream_gold_signals": _stream_gold,
        "stream_window_demand": _stream_windows,
    }
    if llm_queries:
        out |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same columns, by query name."""
    out = dict(ORACLE)
    if llm_queries:
        out |= llm_queries.ORACLE
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
