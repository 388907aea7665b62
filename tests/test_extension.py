"""What an extension carries on: signals per pair, the gap-filled panel, the history of snapshots."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import day, dims, plan_of, pos_frame, random_sales, rows_of, sale
from shelfwise import operators as op
from shelfwise.plans import gold, refresh, signals, silver, snapshot
from shelfwise.schemas import GOLD, SILVER
from shelfwise.sources import testdata as td


@pytest.fixture()
def database(spark, request):
    name = re.sub(r"\W+", "_", f"x_{request.node.name}")[-60:].strip("_")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def panel_rows(df):
    return rows_of(df, "store_id", "sku_id", "transaction_date", "qty_sold", "unit_price", "inventory_on_hand", "is_gap")


def check(spark, tables, sales):
    pos = pos_frame(spark, sales)
    rows = silver(pos)
    assert rows_of(spark.table(tables.name(refresh.PER_PAIR))) == rows_of(gold(rows, latest="per_key"))
    assert panel_rows(refresh.panel(tables)) == panel_rows(op.dense_daily(op.dedup(pos)))


@pytest.mark.parametrize("starts", [(20, 45), (30, 25)])
def test_signals_per_pair_and_panel_equal_the_batch(spark, database, starts):
    """Forwards, and back before the last date; a pair starts late, another sells nothing later."""
    stores, skus = dims(spark, range(4), range(5))
    sales = [r for r in random_sales(41, n=200, days=52) if r[:2] not in {(0, 0), (1, 1)}]
    sales += [sale(0, 0, 46, 3), sale(1, 1, 2, 3)]
    early = [r for r in sales if r[2] < day(starts[0])]
    tables = refresh.run(spark, database, pos_frame(spark, early), stores, skus, with_panel=True)
    check(spark, tables, early)
    for start in starts:
        refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(start))
        check(spark, tables, sales)


def test_dates_without_sales_between_two_refreshes(spark, database):
    stores, skus = dims(spark)
    first, more = [sale(1, 1, 0, 4), sale(1, 2, 3, 4)], [sale(1, 1, 9, 4), sale(2, 1, 9, 1)]
    tables = refresh.run(spark, database, pos_frame(spark, first), stores, skus, with_panel=True)
    before = {part: run for _, part, run in tables.parts()[refresh.PANEL]}
    refresh.extend(spark, database, pos_frame(spark, first + more), stores, skus, day(8))
    check(spark, tables, first + more)
    after = {part: run for _, part, run in tables.parts()[refresh.PANEL]}
    assert {part for part in after if after[part] != before.get(part)} == {str(day(n)) for n in range(4, 10)}
    # The last dates are emptied again, then all of them.
    refresh.extend(spark, database, pos_frame(spark, first), stores, skus, day(8))
    check(spark, tables, first)
    refresh.extend(spark, database, pos_frame(spark, []), stores, skus, day(0))
    check(spark, tables, [])
    refresh.extend(spark, database, pos_frame(spark, more), stores, skus, day(9))
    check(spark, tables, more)


def test_an_empty_start(spark, database):
    """Tables that began without a date show only the rows that are named."""
    stores, skus = dims(spark)
    tables = refresh.run(spark, database, pos_frame(spark, []), stores, skus, with_panel=True)
    check(spark, tables, [])
    sales = [sale(1, 1, n, 4) for n in range(5)]
    for start, rows in ((0, sales), (3, sales[:4] + [sale(1, 2, 4, 9)])):
        refresh.extend(spark, database, pos_frame(spark, rows), stores, skus, day(start))
        check(spark, tables, rows)
        assert spark.table(tables.name(SILVER)).count() == 5


def test_signals_per_pair_read_the_newest_tail_only(spark, database):
    stores, skus = dims(spark, range(4), range(5))
    tables = refresh.run(spark, database, pos_frame(spark, random_sales(42, n=200)), stores, skus)
    plan = plan_of(signals(refresh.last_rows(tables.begin())))
    assert tables.stored(refresh.TAIL) in plan and tables.stored(SILVER) not in plan


def served(rows):
    return rows_of(rows, "metric", "dim", "value")


def test_snapshots_of_earlier_dates_can_be_read(spark, database):
    stores, skus = dims(spark, range(4), range(5))
    sales, expected = random_sales(43, n=300, days=30), {}
    for last in (14, 22, 29, 25):  # the last one goes back: what came after it is withdrawn
        rows = pos_frame(spark, [r for r in sales if r[2] <= day(last)])
        step = refresh.extend if expected else refresh.run
        tables = step(spark, database, rows, stores, skus, *([day(10)] if expected else []))
        now = rows_of(spark.table(tables.name(GOLD)), "signal_date")[0][0]
        expected = {date: lines for date, lines in expected.items() if date < now}
        expected[now] = served(spark.table(tables.name(refresh.SNAPSHOT)))
        changes = spark.table(tables.name(refresh.CHANGES))
        for date, lines in expected.items():
            assert served(snapshot.snapshot_as_of(changes, date)) == lines
        assert served(snapshot.snapshot_as_of(changes)) == expected[now]
    assert served(snapshot.snapshot_as_of(changes, day(-1))) == []
    # Of the later dates only the lines that changed are stored.
    assert 0 < changes.where(F.col("signal_date") == now).count() < len(expected[now]) + changes.where("removed").count()


def test_changes_of_a_snapshot(spark):
    shape = "metric string, dim string, value double"
    before = spark.createDataFrame([("a", "x", 1.0), ("b", "x", None), ("c", "x", 3.0), ("d", "x", 4.0)], shape)
    now = spark.createDataFrame([("a", "x", 1.0), ("b", "x", None), ("c", "x", None), ("e", "x", 5.0)], shape)
    assert rows_of(snapshot.snapshot_changes(now, before)) == [
        ("c", "x", None, False), ("d", "x", None, True), ("e", "x", 5.0, False)]
    assert snapshot.snapshot_changes(now, now).isEmpty()


def test_faulty_rows_of_the_reading_by_part(spark):
    """Both rules are violated, keys are unknown, and the trend leaves dates out."""
    folder = "/root/testdata/sf0.001"
    rows = silver(td.pos_by_part(spark, folder), td.COPY_ORDER)
    assert all(line["failed"] > 0 and line["passed"] > 0 for line in op.rule_report(rows).collect())
    assert rows.select("transaction_date").distinct().count() > 30
    stores, skus = td.stores(spark, folder), td.skus_by_part(spark, folder)
    assert 0 < op.with_stores(rows, stores).count() < rows.count()
    assert 0 < op.with_skus(rows, skus).count() < rows.count()
    assert skus.count() == td.load(spark, folder, "part").count()


def test_signals_per_pair_are_marked_in_the_tail(spark, database):
    """No shuffle finds them; a last row without stock and quantity counts as well."""
    stores, skus = dims(spark, range(4), range(5))
    sales = [r for r in random_sales(44, n=300, days=50) if r[0] != 3 or r[2] < day(30)]
    sales += [sale(7, 1, 3, None, None), sale(7, 1, 41, None, None), sale(8, 1, 2, None, None), sale(None, 1, 5, 2), sale(None, None, 44, 2)]
    tables = refresh.run(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(40)]), stores, skus)
    for _ in range(2):
        assert "Exchange" not in plan_of(signals(refresh.last_rows(tables.begin())))
        stored = spark.table(tables.name(SILVER)).drop("load_timestamp")
        assert rows_of(spark.table(tables.name(refresh.PER_PAIR))) == rows_of(gold(stored, latest="per_key"))
        tables = refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(40))


def test_tables_whose_tail_has_no_marks_are_extended(spark, database, monkeypatch):
    """The tail had another name then; silver is searched once and a marked tail stored."""
    stores, skus = dims(spark, range(4), range(5))
    sales = random_sales(45, n=200, days=50)
    with monkeypatch.context() as patch:
        patch.setattr(refresh, "TAIL", "silver_tail")
        refresh.run(spark, database, pos_frame(spark, [r for r in sales if r[2] < day(40)]), stores, skus, with_panel=True)
    tables = refresh.extend(spark, database, pos_frame(spark, sales), stores, skus, day(40))
    check(spark, tables, sales)
