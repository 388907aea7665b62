"""The physical plans that matter at scale."""

import functools
import importlib
import re

import pytest

from helpers import day, pos_frame, random_sales, rows_of
from shelfwise.operators import dense_daily, dedup
from shelfwise.plans import gold, silver
from shelfwise.schemas import POS

ENTRY = importlib.import_module("__spark_entry__")
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pos(spark, tmp_path_factory):
    """A stored landing folder, so that size statistics are those of files."""
    path = str(tmp_path_factory.mktemp("landing") / "pos")
    pos_frame(spark, random_sales(8, n=2000)).write.parquet(path)
    return spark.read.schema(POS).parquet(path)


def nodes(df, name):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(rf"[+:]- \*?(\(\d+\) )?{name}", line)]


def test_copies_are_cut_before_the_first_shuffle(pos):
    """Printed from the root down: final limit, shuffle, partial limit."""
    plan = silver(pos)._jdf.queryExecution().executedPlan().toString()
    limits = [m.start() for m in re.finditer("WindowGroupLimit", plan)]
    shuffles = [m.start() for m in re.finditer("Exchange hashpartitioning", plan)]
    assert len(limits) == 2 and limits[0] < shuffles[1] < limits[1]


def test_silver_shuffles_twice_and_colocated_once(pos):
    assert len(nodes(silver(pos), "Exchange")) == 2
    assert len(nodes(silver(pos, colocate=True), "Exchange")) == 1
    assert len(nodes(silver(pos, colocate=True), "Sort")) == 1


def test_latest_per_key_reuses_the_rolling_sort(pos):
    assert len(nodes(gold(silver(pos), latest="per_key"), "Exchange")) == 2


def test_latest_per_key_of_stored_silver_sends_one_row_per_pair_and_task(spark, pos, tmp_path):
    path = str(tmp_path / "silver")
    silver(pos).write.partitionBy("transaction_date").parquet(path)
    signals = gold(spark.read.parquet(path), latest="per_key")
    plan = signals._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]
    assert rows_of(signals) == rows_of(gold(silver(pos), latest="per_key"))


def test_dense_panel_needs_no_join(pos):
    plan = dense_daily(dedup(pos))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_gold_reads_one_date_of_stored_silver(spark, pos, tmp_path):
    path = str(tmp_path / "silver")
    silver(pos).write.partitionBy("transaction_date").parquet(path)
    stored = spark.read.parquet(path)
    signals = gold(stored)
    assert rows_of(signals) == rows_of(gold(silver(pos)))
    scan = nodes(signals, "FileScan")[0]
    assert re.search(r"PartitionFilters: \[.*transaction_date.*Subquery", scan)
    signals.collect()
    final = signals._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in final.split("Subquery")[0]


def test_known_date_prunes_without_a_subquery(spark, pos, tmp_path):
    path = str(tmp_path / "silver")
    silver(pos).write.partitionBy("transaction_date").parquet(path)
    signals = gold(spark.read.parquet(path), as_of=day(3))
    plan = signals._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "transaction_date" in plan.split("PartitionFilters")[1]
    assert rows_of(signals.select("signal_date").distinct()) == [(day(3),)]


def test_filters_and_columns_reach_the_scan(spark):
    stores = ENTRY.td.stores(spark, FOLDER)
    scan = nodes(stores.where("state = 'NATION_18'").select("store_id"), "FileScan")
    assert any("EqualTo(n_name,NATION_18)" in line for line in scan)
    assert all("s_acctbal" not in line for line in scan)


def test_no_registered_query_uses_python_or_a_product_join(spark, monkeypatch):
    """Reads are shared between the queries: each would infer its schemas anew."""
    monkeypatch.setattr(ENTRY.td, "load", functools.lru_cache(ENTRY.td.load))
    apart = set(ENTRY.llm_queries.QUERIES) | {"pipeline"} if ENTRY.llm_queries else set()
    batch = {n: q for n, q in ENTRY.queries().items()
             if not n.startswith(("stream_", "extended_", "stored_")) and n != "materialised_gold" and n not in apart}
    for name, query in batch.items():
        plan = query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ArrowEval", "MapInArrow", "FlatMap"):
            assert banned not in plan, (name, banned)


def test_large_dimensions_are_not_broadcast(spark, pos):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        query = ENTRY.queries()["top_alerts_10"](spark, FOLDER)
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
