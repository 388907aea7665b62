"""Streams end in the same tables as the batch: duplicates, late rows, replays."""

import pytest
from pyspark.sql import functions as F

from helpers import day, plan_of, pos_frame, random_sales, rows_of, sale
from shelfwise.operators import dedup
from shelfwise.plans import gold, silver
from shelfwise.sources import stream_pos
from shelfwise.streaming import (
    CellStore, LiveSignals, WindowStore, closed_cells, ingest, pane_windows, run_available, window_demand,
)
from shelfwise.streaming.live import RecentRows


def land(spark, folder, batches):
    """One file per batch, in order."""
    for n, rows in enumerate(batches):
        pos_frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/part={n}")
    return f"{folder}/part=*"


def split(sales, n):
    return [sales[i::n] for i in range(n)]


class Stream:
    """Files that land one by one, and the live signals of them."""

    def __init__(self, spark, tmp_path, **options):
        self.spark, self.folder, self.files = spark, str(tmp_path / "in"), 0
        self.checkpoint = str(tmp_path / "ck")
        self.live = LiveSignals(spark, str(tmp_path / "state"), buckets=16, **options)

    def add(self, rows):
        pos_frame(self.spark, rows).coalesce(1).write.parquet(f"{self.folder}/part={self.files}")
        self.files += 1

    def run(self):
        return run_available(self.live.start(stream_pos(self.spark, f"{self.folder}/part=*", max_files=1), self.checkpoint))

    def current(self, **options):
        return rows_of(self.live.current(self.checkpoint, **options))


def test_live_signals_equal_batch_after_every_batch(spark, tmp_path):
    """Late rows and copies in every file; each run takes up the state of the one before."""
    stream, seen = Stream(spark, tmp_path), []
    for rows in split(random_sales(31, n=600, days=60), 4):
        stream.add(rows)
        stream.run()
        seen += rows
        batch = silver(pos_frame(spark, seen))
        assert stream.current() == rows_of(gold(batch, latest="per_key"))
        assert stream.current(latest="global") == rows_of(gold(batch))
    first = silver(pos_frame(spark, seen[:150]))
    assert stream.current(batch_id=0) == rows_of(gold(first, latest="per_key"))


def test_batch_signals_cover_the_touched_pairs_only(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.add([sale(1, 1, 0, 9), sale(2, 2, 0, 9)])
    stream.add([sale(2, 2, 1, 3)])
    stream.run()
    assert stream.live.last_batch() == 1
    assert rows_of(stream.live.changed(1), "store_id", "avg_daily_demand_7d") == [(2, 6.0)]


def test_a_batch_of_one_pair_writes_one_bucket(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.add([sale(s, k, n, n) for s in range(20) for k in range(5) for n in range(3)])
    stream.run()
    stream.add([sale(3, 3, 9, 1)])
    progress = stream.run().lastProgress.stateOperators[0]
    assert progress.numRowsTotal == 16 and progress.numRowsUpdated == 1


def test_state_holds_fourteen_rows_per_pair(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.add([sale(1, 1, n, n) for n in range(40)])
    stream.add([sale(1, 1, 45, 1), sale(1, 1, 3, 1)])
    stream.run()
    rows = stream.live.state(stream.checkpoint)
    assert sorted(rows_of(rows, "transaction_date")) == [(day(n),) for n in (*range(27, 40), 45)]


def test_a_run_without_new_files_changes_nothing(spark, tmp_path):
    stream, sales = Stream(spark, tmp_path), random_sales(42, n=200)
    for rows in split(sales, 2):
        stream.add(rows)
    for _ in range(2):
        stream.run()
    assert stream.live.last_batch() == 1
    assert stream.current() == rows_of(gold(silver(pos_frame(spark, sales)), latest="per_key"))


def test_changed_signals_of_old_batches_make_room(spark, tmp_path):
    stream, batches = Stream(spark, tmp_path, kept=3), split(random_sales(43, n=120), 5)
    for rows in batches:
        stream.add(rows)
    stream.run()
    slots = sorted(p.name for p in (tmp_path / "state" / "signals").iterdir())
    assert slots == ["slot=0", "slot=1", "slot=2"]
    assert stream.live.changed(1).isEmpty() and not stream.live.changed(2).isEmpty()


NAN = float("nan")


def test_rows_are_compared_as_spark_sorts_them(spark):
    """Nulls first, NaN last, text by bytes; in the state as in the batch."""
    columns = ["store_id", "sku_id", "transaction_date", "text", "number"]
    texts, numbers = [None, "", "Z", "a", "é", "\U0001F600", "\uFFFD"], [None, NAN, -1.0, 0.5, float("inf")]
    rows = [(1, i % 3, day(0), t, x) for i, (t, x) in enumerate((t, x) for t in texts for x in numbers)]
    df = spark.createDataFrame(rows, "store_id long, sku_id long, transaction_date date, text string, number double")
    for order in (["text", "number"], ["number", "text"]):
        held = RecentRows(columns, order)
        held.add(rows)
        assert sorted(map(repr, held.rows())) == sorted(repr(tuple(r)) for r in dedup(df, order_by=order).collect())


def test_ingest_is_idempotent_and_incremental(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    source = land(spark, folder, [[sale(1, 1, 0, 1)], [sale(1, 1, 1, 2)]])
    stream = lambda: stream_pos(spark, source, max_files=1)
    writer = lambda: ingest(stream(), out, str(tmp_path / "ck"))
    run_available(writer())
    run_available(writer())
    assert spark.read.parquet(out).count() == 2
    pos_frame(spark, [sale(1, 1, 2, 3)]).write.mode("append").parquet(f"{folder}/part=9")
    run_available(writer())
    rows = rows_of(spark.read.parquet(out), "qty_sold", "batch_id")
    assert [qty for qty, _ in rows] == [1, 2, 3]
    assert len({batch for _, batch in rows}) == 3


def collect_stream(spark, df, tmp_path, name):
    path = str(tmp_path / name)
    run_available(df.writeStream.format("parquet").outputMode("append").option("path", path)
                  .option("checkpointLocation", f"{path}-ck"))
    return spark.read.schema(df.schema).parquet(path)


def test_closed_cells_keep_the_batch_survivor(spark, tmp_path):
    sales = sorted(random_sales(34, n=500, days=10), key=lambda r: r[2])
    source = land(spark, str(tmp_path / "in"), [sales[:250], sales[250:]])
    cells = collect_stream(
        spark, closed_cells(stream_pos(spark, source, max_files=1)), tmp_path, "cells").drop("day")
    expected = dedup(pos_frame(spark, sales)).where(
        F.col("transaction_date") <= F.lit(max(r[2] for r in sales)) - F.expr("INTERVAL 2 DAYS"))
    assert rows_of(cells) == rows_of(expected)


def test_rows_for_emitted_dates_are_dropped(spark, tmp_path):
    source = land(spark, str(tmp_path / "in"), [
        [sale(1, 1, 0, 5), sale(1, 1, 9, 5)], [sale(1, 1, 12, 5)], [sale(1, 1, 0, 1), sale(1, 1, 12, 1)]])
    cells = collect_stream(
        spark, closed_cells(stream_pos(spark, source, max_files=1)), tmp_path, "cells")
    assert rows_of(cells, "transaction_date", "qty_sold") == [(day(0), 5), (day(9), 5)]


def test_window_demand_counts_days_in_batch_and_stream(spark, tmp_path):
    sales = [sale(1, 1, n, 10) for n in (0, 1, 6, 7, 20)]
    batch = window_demand(dedup(pos_frame(spark, sales)).withColumn(
        "day", F.col("transaction_date").cast("timestamp")))
    by_start = {r.window_start: r.demand_window_7d for r in batch.collect()}
    assert by_start[day(0)] == 30 and by_start[day(1)] == 30 and by_start[day(7)] == 10
    source = land(spark, str(tmp_path / "in"), [sales])
    streamed = collect_stream(
        spark, window_demand(closed_cells(stream_pos(spark, source))), tmp_path, "windows")
    assert rows_of(streamed) == rows_of(batch.where(F.col("window_end") <= F.lit(day(18))))


@pytest.mark.parametrize("order", ["dates", "reversed", "mixed"])
def test_cell_store_equals_batch_however_files_arrive(spark, tmp_path, order):
    sales = random_sales(41, n=500)
    parts = split(sorted(sales, key=lambda r: r[2]) if order != "mixed" else sales, 4)
    parts = list(reversed(parts)) if order == "reversed" else parts
    source = land(spark, str(tmp_path / "in"), [*parts, sales[:40]])
    store = CellStore(spark, str(tmp_path / "state"), compact_every=2)
    for _ in range(2):  # the second run finds no files
        run_available(store.start(stream_pos(spark, source, max_files=1), str(tmp_path / "ck")))
    expected = dedup(pos_frame(spark, sales))
    assert rows_of(store.current()) == rows_of(expected.select(*store.current().columns))


def test_thirty_batches_leave_bounded_folders(spark, tmp_path):
    """Two versions of a date at most, slots for two generations, and late rows still win."""
    sales = random_sales(44, n=600, days=6)
    store, seen = CellStore(spark, str(tmp_path / "state"), compact_every=5), []
    for n, rows in enumerate(split(sales, 30)):
        store.process(pos_frame(spark, rows), n)
        seen += rows
        if n in (4, 12, 29):
            assert rows_of(store.current(n)) == rows_of(dedup(pos_frame(spark, seen)).select(*store.current(n).columns))
    names = lambda kind: sorted(p.name for p in (tmp_path / "state" / kind).iterdir() if "=" in p.name)
    assert len(names("recent")) == 10 and names("versions") == ["slot=0", "slot=1"] and len(names("cells")) == 6
    versions = [p for d in (tmp_path / "state" / "cells").iterdir() if d.is_dir() for p in d.iterdir() if "=" in p.name]
    assert len(versions) <= 12


def test_a_merge_rewrites_the_dates_it_touches_only(spark, tmp_path):
    store = CellStore(spark, str(tmp_path / "state"), compact_every=1)
    files = lambda: {(p.parent.name, p.name) for p in (tmp_path / "state" / "cells").glob("*/*/*.parquet")}
    store.process(pos_frame(spark, [sale(1, 1, n, 9) for n in range(5)]), 0)
    before = files()
    store.process(pos_frame(spark, [sale(1, 1, 2, 3), sale(1, 2, 2, 1)]), 1)
    after = files()
    assert before < after and {v for v, _ in after - before} == {"version=1"} and len(after - before) == 1
    assert store.versions(1) == {day(n): int(n == 2) for n in range(5)}
    assert rows_of(store.current(), "sku_id", "transaction_date", "qty_sold")[2] == (1, day(2), 3)
    assert len(rows_of(store.current(0))) == 5  # the generation before is still whole


def test_a_merge_that_failed_is_repeated(spark, tmp_path, monkeypatch):
    """A run that stops between a merge's rows and its table of versions leaves the old table readable."""
    store = CellStore(spark, str(tmp_path / "state"), compact_every=2)
    batches = split(random_sales(45, n=200, days=8), 4)
    for n in range(3):
        store.process(pos_frame(spark, batches[n]), n)
    expected = rows_of(store.current(2))
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        rows = spark.read.parquet(land_one(tmp_path, batches[3], pos_frame, spark, patch))
        with pytest.raises(RuntimeError):
            store.process(rows, 3)
    assert rows_of(store.current(2)) == expected
    store.process(rows, 3)
    assert rows_of(store.current(3)) == rows_of(dedup(pos_frame(spark, sum(batches, []))).select(*store.current().columns))


def land_one(tmp_path, rows, make, spark, patch):
    patch.undo()
    path = str(tmp_path / "one")
    make(spark, rows).write.parquet(path)
    patch.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    return path


@pytest.mark.parametrize("order", ["dates", "reversed", "mixed"])
def test_window_store_equals_batch_however_files_arrive(spark, tmp_path, order):
    sales = random_sales(46, n=300, days=30)
    parts = split(sorted(sales, key=lambda r: r[2]) if order != "mixed" else sales, 4)
    parts = list(reversed(parts)) if order == "reversed" else parts
    store = WindowStore(spark, str(tmp_path / "state"), compact_every=2)
    for n, rows in enumerate([*parts, sales[:20]]):
        store.process(pos_frame(spark, rows), n)
    cells = dedup(pos_frame(spark, sales))
    assert rows_of(store.current()) == rows_of(pane_windows(cells))
    assert rows_of(pane_windows(cells)) == rows_of(window_demand(cells.withColumn("day", F.col("transaction_date").cast("timestamp"))))


def test_windows_of_nulls_and_of_no_rows(spark):
    rows = [(1, 1, day(0), None, 1.0, 1), (1, 1, day(3), 5, 1.0, 1), (1, 2, None, 7, 1.0, 1), (1, 2, day(1), None, 1.0, 1)]
    cells = pos_frame(spark, rows)
    assert rows_of(pane_windows(cells)) == rows_of(window_demand(cells.withColumn("day", F.col("transaction_date").cast("timestamp"))))
    assert pane_windows(cells.limit(0)).count() == 0


def test_panes_are_shuffled_once_and_not_copied_for_their_windows(spark):
    plan = plan_of(pane_windows(pos_frame(spark, [sale(1, 1, 0, 1)])))
    assert plan.count("Exchange") == 1 and "Expand" not in plan and "Aggregate" not in plan
    assert plan.index("Generate") < plan.index("Exchange")  # printed from the root down: copies are made after the shuffle


def test_a_late_row_changes_its_own_windows_only(spark, tmp_path):
    store = WindowStore(spark, str(tmp_path / "state"))
    store.process(pos_frame(spark, [sale(1, 1, n, 10) for n in range(0, 40, 4)]), 0)
    files = lambda: {p for p in (tmp_path / "state" / "windows").glob("*/*.parquet")}
    before = files()
    store.process(pos_frame(spark, [sale(1, 1, 17, 5)]), 1)
    changed = {p.parent.name for p in before ^ files()}
    assert changed == {f"window_start={day(n)}" for n in range(11, 18)}


def test_the_state_is_packed_in_columns(spark, tmp_path):
    """A bucket's rows are one message; numbers that a double can't hold, nulls and equal rows come back whole."""
    rows = [(2**53 + 1, k % 3, None if k == 5 else day(k % 4), None if k % 5 == 0 else k, NAN if k % 7 == 0 else 1.5, k or None)
            for k in range(40)]
    stream = Stream(spark, tmp_path)
    for part in (rows[:25], rows[20:]):
        stream.add(part)
    stream.run()
    kept = spark.read.format("statestore").load(stream.checkpoint).select("value.groupState.*")
    assert [f.dataType.simpleString() for f in kept.schema] == ["binary"]
    expected = dedup(pos_frame(spark, rows))
    assert stream.live.state(stream.checkpoint).schema == pos_frame(spark, rows).schema
    assert list(map(repr, rows_of(stream.live.state(stream.checkpoint)))) == list(map(repr, rows_of(expected)))
    assert stream.current() == rows_of(gold(silver(pos_frame(spark, rows)), latest="per_key"))


def test_a_task_hands_on_what_it_holds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("shelfwise.streaming.live.HELD", 40)
    stream, sales = Stream(spark, tmp_path), random_sales(47, n=300)
    stream.add(sales)
    stream.run()
    assert stream.current() == rows_of(gold(silver(pos_frame(spark, sales)), latest="per_key"))


def test_batches_of_many_dates_do_not_rewrite_the_store_each_time(spark, tmp_path):
    """Windows are summed at the first batch and at merges by which the rows have doubled; readers see all rows at any time."""
    sales = random_sales(48, n=360, days=20)
    store, seen, summed = WindowStore(spark, str(tmp_path / "state"), compact_every=2), [], []
    files = lambda: set((tmp_path / "state" / "windows").glob("*/*.parquet"))
    for n, rows in enumerate(split(sales, 9)):
        before = files()
        store.process(pos_frame(spark, rows), n)
        seen += rows
        summed += [n] * (files() != before)
        if n in (2, 5, 8):
            assert rows_of(store.current()) == rows_of(pane_windows(dedup(pos_frame(spark, seen))))
    assert summed == [0, 1, 3, 7]
    late = [sale(1, 1, 4, 77), sale(9, 9, 19, 5)]
    store.process(pos_frame(spark, late), 9)
    assert rows_of(store.current()) == rows_of(pane_windows(dedup(pos_frame(spark, [*seen, *late]))))
    before = rows_of(store.current())
    store.process(pos_frame(spark, late), 9)  # replayed
    assert rows_of(store.current()) == before


def test_windows_and_merged_cells_are_not_shuffled_to_gather_dates(spark, tmp_path, monkeypatch):
    hints, hint = [], type(spark.range(0)).hint
    monkeypatch.setattr(type(spark.range(0)), "hint", lambda self, *a: hints.append(a) or hint(self, *a))
    store = WindowStore(spark, str(tmp_path / "state"), compact_every=1)
    store.process(pos_frame(spark, random_sales(49, n=50)), 0)
    assert not hints
    assert "Window" not in plan_of(store.cells.merged(0, {day(n) for n in range(40)}))
