"""The batch refresh into tables."""

import re
import shutil

import pytest
from pyspark.sql import functions as F

from helpers import brute_signals, day, dims, plan_of, pos_frame, random_sales, rows_of, sale
from shelfwise.plans import gold, kpis, refresh, signal_history, silver
from shelfwise.plans.daily import coverage_of, daily_figures, trend_of
from shelfwise.plans.layers import silver_since
from shelfwise.schemas import BRONZE, GOLD, POS, SILVER
from shelfwise.sources import Change, read_pos, read_table, write_dates, write_parquet


@pytest.fixture()
def database(spark, request):
    name = re.sub(r"\W+", "_", f"t_{request.node.name}")[-60:].strip("_")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_refresh_writes_every_layer(spark, database):
    sales = random_sales(21)
    stores, skus = dims(spark, range(4), range(5))
    pos = pos_frame(spark, sales)
    tables = refresh.run(spark, database, pos, stores, skus)
    expected = gold(silver(pos))
    assert rows_of(read_table(spark, tables.name(GOLD))) == rows_of(expected)
    assert read_table(spark, tables.name(SILVER)).count() == len(brute_signals(sales))
    assert read_table(spark, tables.name(BRONZE)).count() == len(sales)
    report = read_table(spark, tables.name(refresh.QUALITY), ["rule", "failed"])
    assert rows_of(report) == [("valid_inventory", 0), ("valid_qty", 0)]
    orders = read_table(spark, tables.name(refresh.ORDERS))
    assert orders.count() == kpis.reorder_rows(expected).count()
    columns = spark.catalog.listColumns(tables.stored(SILVER))
    assert [c.name for c in columns if c.isPartition] == ["transaction_date", "run"]
    assert "reorder status" in spark.catalog.getTable(tables.name(GOLD)).description


def test_running_again_changes_nothing(spark, database):
    stores, skus = dims(spark, range(4), range(5))
    pos = pos_frame(spark, random_sales(22))
    for _ in range(2):
        tables = refresh.run(spark, database, pos, stores, skus)
    assert rows_of(spark.table(tables.name(GOLD))) == rows_of(gold(silver(pos)))
    assert spark.table(tables.name(refresh.ORDERS)).count() == \
        kpis.reorder_rows(spark.table(tables.name(GOLD))).count()


def test_dates_that_disappear_leave_silver_but_not_the_orders(spark, database):
    stores, skus = dims(spark)
    first = pos_frame(spark, [sale(1, 1, 0, 9, 0), sale(1, 1, 5, 9, 0)])
    refresh.run(spark, database, first, stores, skus)
    tables = refresh.run(spark, database, pos_frame(spark, [sale(1, 1, 7, 9, 0)]), stores, skus)
    assert rows_of(spark.table(tables.name(SILVER)), "transaction_date") == [(day(7),)]
    assert rows_of(spark.table(tables.name(refresh.ORDERS)), "signal_date") == [(day(5),), (day(7),)]


def test_bronze_over_a_landing_folder_copies_nothing(spark, database, tmp_path):
    stores, skus = dims(spark, range(4), range(5))
    landing = str(tmp_path / "landing")
    write_parquet(pos_frame(spark, random_sales(23)), landing)
    pos = read_pos(spark, landing)
    for _ in range(2):
        tables = refresh.run(spark, database, pos, stores, skus, landing=landing)
    assert spark.catalog.getTable(tables.name(BRONZE)).tableType == "EXTERNAL"
    assert spark.table(tables.name(BRONZE)).count() == 600
    assert read_pos(spark, landing).count() == 600


def test_empty_input(spark, database):
    stores, skus = dims(spark)
    tables = refresh.run(spark, database, pos_frame(spark, []), stores, skus)
    assert spark.table(tables.name(GOLD)).isEmpty()
    assert set(kpis.kpi_summary(spark.table(tables.name(GOLD)), skus).first().asDict().values()) == {0}


def test_rules_reach_gold(spark, database):
    stores, skus = dims(spark)
    pos = pos_frame(spark, [sale(1, 1, 0, 0, 0)])
    tables = refresh.run(spark, database, pos, stores, skus, zero_demand_policy="reorder_if_empty")
    assert spark.table(tables.name(GOLD)).first().replenishment_status == "REORDER NOW"


@pytest.mark.parametrize("lookback", [1, 5, 28])
def test_silver_since_equals_full_silver(spark, lookback):
    sales = random_sales(24, n=500, days=60)
    full = silver(pos_frame(spark, sales)).persist()
    for n in (0, 30, 59):
        later = F.col("transaction_date") >= F.lit(day(n))
        part = silver_since(pos_frame(spark, sales), full.where(~later), day(n), lookback_days=lookback)
        assert rows_of(part) == rows_of(full.where(later))
    full.unpersist()


def test_extending_equals_refreshing(spark, database):
    stores, skus = dims(spark, range(4), range(5))
    sales = random_sales(25, n=500, days=50)
    early = [r for r in sales if r[2] < day(40)]
    refresh.run(spark, database, pos_frame(spark, early), stores, skus)
    for _ in range(2):
        tables = refresh.extend(
            spark, database, pos_frame(spark, sales), stores, skus, day(40), lookback_days=10)
        stored = spark.table(tables.name(SILVER)).select(*POS.names, "avg_daily_demand_7d", "avg_daily_demand_14d")
        expected = silver(pos_frame(spark, sales))
        assert rows_of(stored) == rows_of(expected)
        assert rows_of(spark.table(tables.name(GOLD))) == rows_of(gold(expected))
    assert spark.table(tables.name(refresh.QUALITY)).count() == 6


def test_extending_with_nothing_new(spark, database):
    stores, skus = dims(spark)
    pos = pos_frame(spark, [sale(1, 1, 0, 9, 0)])
    refresh.run(spark, database, pos, stores, skus)
    tables = refresh.extend(spark, database, pos, stores, skus, day(5))
    assert rows_of(spark.table(tables.name(GOLD)), "signal_date") == [(day(0),)]


def test_withdrawn_orders_go(spark, database):
    stores, skus = dims(spark)
    refresh.run(spark, database, pos_frame(spark, [sale(1, 1, 5, 9, 0)]), stores, skus)
    tables = refresh.run(spark, database, pos_frame(spark, [sale(1, 1, 5, 9, 500)]), stores, skus)
    assert spark.table(tables.name(refresh.ORDERS)).count() == 0


def test_extending_drops_dates_that_have_no_rows_any_more(spark, database):
    stores, skus = dims(spark)
    early = [sale(1, 1, 0, 9, 0), sale(1, 1, 1, 9, 0)]
    refresh.run(spark, database, pos_frame(spark, [*early, sale(1, 1, 3, 9, 0)]), stores, skus)
    tables = refresh.extend(spark, database, pos_frame(spark, early), stores, skus, day(3))
    assert sorted(rows_of(spark.table(tables.name(SILVER)), "transaction_date")) == [(day(0),), (day(1),)]
    assert spark.table(tables.name(BRONZE)).count() == 2
    assert rows_of(spark.table(tables.name(GOLD)), "signal_date") == [(day(1),)]
    tables = refresh.extend(spark, database, pos_frame(spark, [*early, sale(1, 1, 4, 2, 9)]), stores, skus, day(2))
    assert spark.table(tables.name(BRONZE)).count() == 3


def stored_silver(spark, tables):
    return spark.table(tables.name(SILVER)).select(*POS.names, "avg_daily_demand_7d", "avg_daily_demand_14d")


@pytest.mark.parametrize("starts", [(20, 30, 45), (30, 20, 25), (10, 50, 49)])
def test_extending_in_any_order_equals_refreshing(spark, database, starts):
    """Forwards, back before the tails, and onto dates between two tails."""
    stores, skus = dims(spark, range(4), range(5))
    sales = random_sales(26, n=500, days=52)
    refresh.run(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(starts[0])]), stores, skus)
    for start in starts:
        tables = refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(start))
        assert rows_of(stored_silver(spark, tables)) == rows_of(silver(pos_frame(spark, sales)))


def test_extending_reads_no_silver_before_the_tail(spark, database):
    stores, skus = dims(spark, range(4), range(5))
    sales = random_sales(27, n=400, days=52)
    early = pos_frame(spark, [r for r in sales if r[2] < day(40)])
    tables = refresh.run(spark, database, early, stores, skus)
    known = refresh.rows_before(tables.begin(), day(40))
    nothing = spark.table(tables.name(SILVER)).where("false")
    part = silver_since(pos_frame(spark, sales), nothing, day(40), before=known)
    later = F.col("transaction_date") >= F.lit(day(40))
    assert rows_of(part) == rows_of(silver(pos_frame(spark, sales)).where(later))
    assert refresh.rows_before(tables.begin(), day(0)) is None


def state_of(spark, tables, *more):
    """The tables by name; the time of loading aside."""
    return {t: rows_of(spark.table(tables.name(t)).drop("load_timestamp", "month", "checked_at", "computed_at", "valid_until"))
            for t in (BRONZE, SILVER, GOLD, refresh.ORDERS, refresh.SNAPSHOT, refresh.DAILY, *more)}


@pytest.mark.parametrize("lost", [SILVER, GOLD, refresh.ORDERS, "publish"])
def test_a_run_that_is_lost_changes_nothing_and_can_be_repeated(spark, database, monkeypatch, lost):
    stores, skus = dims(spark, range(4), range(5))
    sales = random_sales(28, n=200, days=20)
    tables = refresh.run(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(15)]), stores, skus)
    before = state_of(spark, tables)
    write, publish = Change.write, Change.publish

    def failing_write(self, rows, table, *args, **options):
        write(self, rows, table, *args, **options)
        if table == lost:
            raise RuntimeError("executors lost")

    def failing_publish(self):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(Change, "write", failing_write)
        if lost == "publish":
            patch.setattr(Change, "publish", failing_publish)
        with pytest.raises(RuntimeError):
            refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(15))
    assert state_of(spark, tables) == before
    refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(15))
    expected = silver(pos_frame(spark, sales))
    assert rows_of(stored_silver(spark, tables)) == rows_of(expected)
    assert rows_of(spark.table(tables.name(GOLD))) == rows_of(gold(expected))
    # What the lost run wrote has been dropped: two states are named at most.
    assert len({row["run"] for row in spark.table(tables.stored(GOLD)).select("run").distinct().collect()}) <= 2


def test_untouched_dates_keep_their_files(spark, database):
    stores, skus = dims(spark)
    sales = [sale(1, 1, n, 9) for n in range(10)]
    tables = refresh.run(spark, database, pos_frame(spark, sales[:8]), stores, skus)
    runs = lambda: {part: run for _, part, run in tables.parts()[SILVER]}
    before = runs()
    refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(6))
    after = runs()
    assert {d for d in after if before.get(d) != after[d]} == {str(day(n)) for n in (6, 7, 8, 9)}


def test_extending_finds_new_changed_and_removed_files(spark, database, tmp_path):
    """A file for old dates, one that is written anew, and one that is taken away."""
    stores, skus = dims(spark, range(4), range(5))
    landing, sales = tmp_path / "landing", random_sales(29, n=240, days=40)
    parts = [[r for r in sales if day(a) <= r[2] < day(b)] for a, b in ((0, 15), (15, 25), (25, 40))]

    def land(name, rows):
        write_parquet(pos_frame(spark, rows).coalesce(1), str(tmp_path / name))
        landing.mkdir(exist_ok=True)
        shutil.copy(next((tmp_path / name).glob("*.parquet")), landing / f"{name}.parquet")

    def check(tables, rows, first):
        assert rows_of(stored_silver(spark, tables)) == rows_of(silver(pos_frame(spark, rows)))
        parts = tables.parts()[SILVER]
        assert min(part for _, part, run in parts if run == tables.parts()[GOLD][0][2]) == str(first)

    def extend():
        return refresh.extend(spark, database, read(), stores, skus, landing=str(landing))

    read = lambda: spark.read.schema(POS).parquet(str(landing))
    land("a", parts[0])
    land("c", parts[2])
    tables = refresh.run(spark, database, read(), stores, skus, landing=str(landing))
    assert extend().newest() == 1  # nothing new
    land("b", parts[1])
    check(extend(), sales, day(15))
    land("c", parts[2][:-20])
    check(extend(), [*parts[0], *parts[1], *parts[2][:-20]], day(25))
    (landing / "c.parquet").rename(tmp_path / "taken.parquet")
    extend()
    assert rows_of(stored_silver(spark, tables)) == rows_of(silver(pos_frame(spark, parts[0] + parts[1])))
    assert rows_of(spark.table(tables.name(GOLD)), "signal_date")[-1] == (max(r[2] for r in parts[1]),)


def test_without_since_or_landing_there_is_nothing_to_go_by(spark, database):
    stores, skus = dims(spark)
    refresh.run(spark, database, pos_frame(spark, [sale(1, 1, 0, 9)]), stores, skus)
    with pytest.raises(ValueError):
        refresh.extend(spark, database, pos_frame(spark, []), stores, skus)


def test_trend_and_coverage_come_from_the_daily_tables(spark, database):
    stores, skus = dims(spark, range(4), range(5))
    sales = random_sales(30, n=300, days=45)
    refresh.run(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(40)]), stores, skus)
    tables = refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(40))
    history = signal_history(silver(pos_frame(spark, sales)))
    daily, coverage = spark.table(tables.name(refresh.DAILY)), spark.table(tables.name(refresh.COVERAGE))
    for days in (30, 7, None):
        trend = trend_of(daily, days)
        assert rows_of(trend) == rows_of(kpis.status_trend(history, skus, days))
    assert SILVER not in plan_of(trend)
    for first in (0, 30, 44, 60):
        since = F.col("signal_date") >= F.lit(day(first))
        assert rows_of(coverage_of(coverage.where(since))) == rows_of(kpis.coverage_counts(history.where(since)))


def test_dates_of_a_folder_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "folder")
    write_dates(pos_frame(spark, [sale(1, 1, n, n) for n in range(3)]), path)
    write_dates(pos_frame(spark, [sale(1, 1, 1, 50)]), path)
    assert rows_of(spark.read.parquet(path), "transaction_date", "qty_sold") == [(day(0), 0), (day(1), 50), (day(2), 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_an_extension_meets_the_tail_in_the_shuffle_of_its_frames(spark, database):
    """No join and no second pass over the new rows before it, and nothing is carried that frames do not take."""
    stores, skus = dims(spark, range(4), range(5))
    sales = random_sales(31, n=300, days=50)
    tables = refresh.run(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(40)]), stores, skus)
    known = refresh.rows_before(tables.begin(), day(40))
    part = silver_since(pos_frame(spark, sales), known, day(40), before=known)
    plan = plan_of(part)
    assert "Join" not in plan and plan.count("Exchange") == 2
    assert rows_of(part) == rows_of(silver(pos_frame(spark, sales)).where(F.col("transaction_date") >= F.lit(day(40))))


def test_the_tail_and_the_panel_are_not_shuffled_to_gather_dates(spark, database, monkeypatch):
    stores, skus = dims(spark, range(4), range(5))
    sales = random_sales(32, n=300, days=50)
    frame = type(spark.range(0))
    hints, hint = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, *a: hints.append((a[-1], len(self.columns))) or hint(self, *a))
    refresh.run(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(40)]), stores, skus, with_panel=True)
    tables = refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(40))
    assert "as_of" not in {column for column, _ in hints}
    assert ("transaction_date", 7) not in hints  # the panel's seven columns
    tail = spark.table(tables.stored(refresh.TAIL))
    assert tail.where("unit_price IS NOT NULL").isEmpty() and not tail.isEmpty()


def test_daily_figures_are_counted_before_they_meet_the_skus(spark):
    history = signal_history(silver(pos_frame(spark, random_sales(33, n=300))))
    skus = spark.createDataFrame([(k, f"sku {k}", "dairy", price) for k, price in enumerate([2.123456, None, 0.1, 1e6])],
                                 "sku_id long, sku_name string, category string, avg_unit_price double")
    daily = daily_figures(history, skus.unionByName(skus.where("sku_id = 2")))
    plan = plan_of(daily)
    assert "Aggregate" in plan[plan.index("Join"):]
    value = F.when(kpis.is_reorder(), kpis.revenue()).cast("decimal(28,6)")
    rows = history.join(skus.unionByName(skus.where("sku_id = 2")), "sku_id", "left").groupBy("signal_date").agg(
        F.count(F.lit(1)), F.count_if(kpis.is_reorder()), F.coalesce(F.sum(value), F.lit(0).cast("decimal(38,6)")))
    assert rows_of(daily) == rows_of(rows)
    assert dict(daily.dtypes)["value"] == "decimal(38,6)"


def test_new_rows_reach_the_tail_without_their_demand(spark, database):
    """Of stock and demand the tail has those of a pair's last row alone; the signal of every pair follows from them."""
    stores, skus = dims(spark, range(4), range(5))
    sales = [r for r in random_sales(34, n=400, days=50) if r[0] != 3 or r[2] < day(30)]
    sales += [sale(s, k, n, q) for s, k in ((None, 1), (2, None), (None, None)) for n, q in ((5, 3), (39, 5), (45, 8), (46, None))]
    refresh.run(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(40)]), stores, skus)
    for start, end in ((40, 46), (46, 50)):
        tables = refresh.extend(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(end)]), stores, skus, day(start))
    tail = spark.table(tables.name(refresh.TAIL)).where(F.col("as_of") == F.lit(day(49)))
    full = tail.where("inventory_on_hand IS NOT NULL OR avg_daily_demand_7d IS NOT NULL OR avg_daily_demand_14d IS NOT NULL")
    assert full.groupBy("store_id", "sku_id").count().where("count > 1").isEmpty() and full.count() < tail.count()
    stored = spark.table(tables.name(SILVER)).drop("load_timestamp")
    expected = gold(stored, latest="per_key")
    assert rows_of(spark.table(tables.name(refresh.PER_PAIR))) == rows_of(expected)
    assert expected.where("store_id IS NULL OR sku_id IS NULL").count() == 3 and expected.where("signal_date < '2024-02-01'").count()


def test_copies_are_sent_sorted_by_their_keys(spark):
    """No hash travels with them: neighbours are alike, which halves what a row takes once compressed."""
    pos = pos_frame(spark, random_sales(35))
    for rows in (silver(pos), silver_since(pos, silver(pos), day(1))):
        assert "hash(" not in plan_of(rows).replace("hashpartitioning(", "").lower()


def test_stored_tables_are_packed_with_zstd(spark, database):
    stores, skus = dims(spark, range(4), range(5))
    tables = refresh.run(spark, database, pos_frame(spark, random_sales(36)), stores, skus)
    for table in (SILVER, refresh.TAIL, GOLD):
        files = spark.table(tables.stored(table)).inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_silver_is_not_shuffled_to_gather_dates(spark, database, monkeypatch):
    """Its rows are dealt out by pair already; each task writes the dates it has."""
    stores, skus = dims(spark, range(4), range(5))
    sales = random_sales(37, n=300, days=50)
    frame = type(spark.range(0))
    hints, hint = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, *a: hints.append(a[-1]) or hint(self, *a))
    refresh.run(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(40)]), stores, skus)
    assert hints.count("transaction_date") == 1  # bronze, which no shuffle has dealt out
    tables = refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(40))
    assert hints.count("transaction_date") == 2
    assert rows_of(stored_silver(spark, tables)) == rows_of(silver(pos_frame(spark, sales)))
