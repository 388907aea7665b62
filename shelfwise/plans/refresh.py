"""Batch refresh: landing folder -> bronze, silver, gold, quality and KPI tables, published together."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from shelfwise.operators import DEFAULT_RULES, first_sales, observe_rules, panel_since, whole_panel
from shelfwise.plans.daily import MONTH, by_month, daily_coverage, daily_figures
from shelfwise.plans.kpis import platform_stats
from shelfwise.plans.layers import (
    FRAMES, IS_LAST, gold, signal_history, signals, silver, silver_since, stored_tail, without_demand,
)
from shelfwise.plans.orders import purchase_order_lines
from shelfwise.plans.snapshot import kpi_snapshot, snapshot_as_of, snapshot_changes
from shelfwise.schemas import BRONZE, GOLD, POS, SILVER
from shelfwise.sources import Change, Versions, create_database, ledger, register_folder

# Table comments.
COMMENTS = {
    BRONZE: "Raw point-of-sale rows as they landed",
    SILVER: "Deduplicated sales with 7- and 14-row trailing demand per store and SKU",
    GOLD: "Days of supply and reorder status per store and SKU at the latest date",
}
QUALITY = "data_quality"
SNAPSHOT = "kpi_snapshot"
ORDERS = "purchase_orders"
TAIL = "pair_tail"
DAILY, COVERAGE = "daily_figures", "daily_coverage"
FILES = "landed_files"
PER_PAIR = "signals_per_pair"
CHANGES = "kpi_snapshot_changes"
PANEL, FIRSTS = "daily_panel", "first_sales"
KEPT_TAILS = 4
DEMAND = list(FRAMES)


def _before(since: datetime.date | None):
    """Published dates that stay: those before ``since``, and rows without a date."""
    return (lambda part: part is None or part < since.isoformat()) if since else None


def write_silver(
    change: Change, rows: DataFrame, fmt: str = "parquet", since: datetime.date | None = None
) -> tuple[DataFrame, datetime.date | None]:
    """Write silver by date; the same job yields the quality report and the latest date.

    With ``since`` the dates from there on are replaced and earlier ones stay. The frames have dealt the rows out by
    pair, evenly for every date, so they are written as dealt instead of being shuffled once more to gather dates.
    """
    checks = Observation("quality")

    def watch(shaped: DataFrame) -> DataFrame:
        stamped = shaped.withColumn("load_timestamp", F.current_timestamp())
        return observe_rules(stamped, checks, latest=F.max("transaction_date"))

    change.write(rows, SILVER, "transaction_date", keep=_before(since), fmt=fmt, comment=COMMENTS[SILVER],
                 watch=watch, gather=False)
    counts = checks.get
    lines = [(rule, counts["rows"] - counts[rule], counts[rule]) for rule in DEFAULT_RULES]
    report = rows.sparkSession.createDataFrame(lines, "rule string, passed bigint, failed bigint")
    return report.withColumn("checked_at", F.current_timestamp()), counts["latest"]


def write_tail(
    change: Change, rows: DataFrame, as_of: datetime.date | None, fmt: str = "parquet",
    keep: list[str] | None = None,
) -> None:
    """Store the last 13 silver rows per pair under their date, beside the tails of the dates in ``keep``.

    ``as_of`` is the latest date in ``rows``. An extension starts from the newest tail before its first date.
    Prices are neither shuffled nor stored, as no frame and no signal follows from those of earlier rows. Of a pair's
    stock and demand only those of its last row are stored, which is marked, and new rows are shuffled without the demand.
    """
    kept = sorted(keep or [])[-(KEPT_TAILS - 1):]
    last = stored_tail(rows.select(*[c for c in POS.names if c != "unit_price"], *DEMAND)).select(
        *[F.lit(None).cast("double").alias(c) if c == "unit_price" else c for c in POS.names], *DEMAND, IS_LAST)
    # All rows have one date, and the ranking has already dealt them out by pair.
    change.write(last.withColumn("as_of", F.lit(as_of).cast("date")), TAIL, "as_of", keep=lambda part: part in kept, fmt=fmt,
                 gather=False)


def tails(change: Change) -> list[str]:
    return sorted(part for _, part, _ in change.parts.get(TAIL, []) if part)


def rows_before(change: Change, since: datetime.date) -> DataFrame | None:
    """The rows before ``since`` that later frames can reach, or None where no tail is old enough.

    That is the newest earlier tail and the silver dates after it, so older silver is not read.
    """
    earlier = [date for date in tails(change) if date < since.isoformat()]
    if not earlier:
        return None
    day, newest = F.col("transaction_date"), F.lit(earlier[-1]).cast("date")
    tail = change.read(TAIL).where(F.col("as_of") == newest).select(*POS.names, *DEMAND)
    after = change.read(SILVER).where((day > newest) & (day < F.lit(since)))
    return tail.unionByName(after.select(*POS.names, *DEMAND))


def last_rows(change: Change) -> DataFrame:
    """The last silver row of every pair, as marked in the newest tail; nothing else is read and nothing shuffled."""
    newest = max(tails(change), default=None)
    parts = [part for part in change.parts[TAIL] if newest is not None and part[1] == newest]
    return change.versions.read(TAIL, parts).where(IS_LAST)


def _derive(
    change: Change, bronze: DataFrame, stores: DataFrame, skus: DataFrame, fmt: str,
    as_of: datetime.date | None, since: datetime.date | None = None, **rules,
) -> None:
    """Everything that follows from silver; with ``since`` daily figures are kept for the dates before it."""
    rows = change.read(SILVER)
    change.write(gold(rows, as_of=as_of, **rules), GOLD, fmt=fmt, comment=COMMENTS[GOLD])
    later = rows if since is None else rows.where(F.col("transaction_date") >= F.lit(since))
    history = signal_history(later, **rules)
    _write_daily(change, daily_figures(history, skus), DAILY, fmt, since)
    _write_daily(change, daily_coverage(history), COVERAGE, fmt, since)
    change.write(signals(last_rows(change), **rules), PER_PAIR, fmt=fmt)
    current = change.read(GOLD)
    layers = platform_stats(bronze, rows, current)
    change.write(kpi_snapshot(current, stores, skus, layers), SNAPSHOT, fmt=fmt)
    _write_changes(change, as_of, fmt)
    # All orders have one date, so they are not shuffled to gather it.
    change.write(purchase_order_lines(current, stores, skus), ORDERS, "signal_date", fmt=fmt,
                 keep=lambda part: as_of is None or part != as_of.isoformat(), gather=False)


def _write_changes(change: Change, as_of: datetime.date | None, fmt: str) -> None:
    """In which lines the snapshot of ``as_of`` differs from that of the date before it; later dates are withdrawn."""
    if as_of is None:
        return
    now = change.read(SNAPSHOT)
    if CHANGES in change.parts:
        before = snapshot_as_of(change.read(CHANGES), as_of - datetime.timedelta(days=1))
    else:
        before = now.where(F.lit(False))
    rows = snapshot_changes(now, before).withColumn("signal_date", F.lit(as_of))
    change.write(rows, CHANGES, "signal_date", keep=_before(as_of), fmt=fmt)


def _write_panel(change: Change, as_of: datetime.date | None, fmt: str, since: datetime.date | None = None) -> None:
    """The gap-filled panel by date, and the first date of every pair.

    With ``since`` only that date and later ones are read and written, and before them the dates that have passed
    since the last refresh without a sale; the pairs' first dates are all that is needed of the past.
    """
    rows, known, start = change.read(SILVER), None, None
    stored = [part for _, part, _ in change.parts.get(PANEL, []) if part]
    if since is not None and stored:
        rows = rows.where(F.col("transaction_date") >= F.lit(since))
        start = min(since, datetime.date.fromisoformat(max(stored)) + datetime.timedelta(days=1))
        known = change.read(FIRSTS).where(F.col("first_date") < F.lit(start))
    if as_of is None:  # no date is left
        known, start = None, None
    kept_until = start and min(start, as_of + datetime.timedelta(days=1))
    change.write(panel_since(rows, as_of or datetime.date.max, known, start), PANEL, "transaction_date", fmt=fmt,
                 keep=_before(kept_until) if kept_until else None, gather=False)
    change.write(first_sales(rows, known), FIRSTS, fmt=fmt)


def panel(tables: Versions) -> DataFrame:
    """The stored panel; its columns and rows are those of :func:`dense_daily`."""
    parts = tables.parts()
    return whole_panel(tables.read(PANEL, parts[PANEL]), tables.read(FIRSTS, parts[FIRSTS]))


def _write_daily(change: Change, rows: DataFrame, table: str, fmt: str, since: datetime.date | None) -> None:
    """Figures by month; of the month that ``since`` lies in, those before it are written again."""
    rows, month = by_month(rows), None
    if since and change.parts.get(table):
        month = since.replace(day=1)
        day = F.col("signal_date")
        rows = rows.unionByName(change.read(table).where((F.col(MONTH) == F.lit(month)) & (day < F.lit(since))))
    change.write(rows, table, MONTH, keep=_before(month), fmt=fmt)


def run(
    spark: SparkSession,
    database: str,
    pos: DataFrame,
    stores: DataFrame,
    skus: DataFrame,
    *,
    landing: str | None = None,
    order_by=None,
    fmt: str = "parquet",
    with_panel: bool = False,
    **rules,
) -> Versions:
    """Refresh all tables of ``database``; readers see the old ones until all new ones are there.

    ``with_panel`` also stores the gap-filled panel, which later refreshes keep up and :func:`panel` reads.

    With ``landing`` bronze is a catalog entry over that folder, nothing is copied, and the files read
    are entered in a ledger, from which :func:`extend` finds later changes; otherwise ``pos`` itself is stored.
    """
    create_database(spark, database)
    tables = Versions(spark, database)
    change = tables.begin()
    if landing:
        change.write(ledger.entries(spark, landing), FILES, fmt=fmt)
        register_folder(spark, tables.name(BRONZE), landing, COMMENTS[BRONZE])
        bronze = pos
    else:
        change.write(pos, BRONZE, "transaction_date", fmt=fmt, comment=COMMENTS[BRONZE])
        pos = bronze = change.read(BRONZE)
    report, as_of = write_silver(change, silver(pos, order_by), fmt)
    change.write(report, QUALITY, fmt=fmt)
    write_tail(change, without_demand(change.read(SILVER)), as_of, fmt)
    _derive(change, bronze, stores, skus, fmt, as_of, **rules)
    if with_panel or FIRSTS in change.parts:
        _write_panel(change, as_of, fmt)
    change.publish()
    return tables


def extend(
    spark: SparkSession,
    database: str,
    pos: DataFrame,
    stores: DataFrame,
    skus: DataFrame,
    since: datetime.date | None = None,
    *,
    landing: str | None = None,
    order_by=None,
    lookback_days: int = 28,
    fmt: str = "parquet",
    **rules,
) -> Versions:
    """Refresh after rows were added on dates from ``since`` on; earlier dates stay as they are.

    Without ``since`` it is the first date in the files of ``landing`` that are new, changed or gone since the
    last refresh; where there are none, nothing happens.

    ``pos`` holds all raw rows of those dates, old and new; it may hold more, and is not the bronze
    table itself. Bronze, silver and orders lose stored dates that have no rows any more. A
    failed run changes nothing that readers see, so it can simply be repeated. Older silver is read
    only where the stored tails all reach ``since`` or beyond; ``lookback_days`` is for that case.
    """
    tables = Versions(spark, database)
    change = tables.begin()
    if landing:
        before = change.read(FILES)
        change.write(ledger.entries(spark, landing, before), FILES, fmt=fmt)
        since = since or ledger.first_touched(before, change.read(FILES))
        if since is None:
            return tables
    elif since is None:
        raise ValueError("without a landing folder the first changed date has to be given")
    stays = _before(since)
    if BRONZE in change.parts:
        fresh = pos.where(F.col("transaction_date") >= F.lit(since))
        change.write(fresh, BRONZE, "transaction_date", keep=stays, fmt=fmt)
        bronze = change.read(BRONZE)
    else:
        spark.catalog.refreshTable(tables.name(BRONZE))
        if any(column.isPartition for column in spark.catalog.listColumns(tables.name(BRONZE))):
            spark.catalog.recoverPartitions(tables.name(BRONZE))
        bronze = spark.table(tables.name(BRONZE))
    stored, known = change.read(SILVER), rows_before(change, since)
    kept = [date for date in tails(change) if date < since.isoformat()]
    rows = silver_since(pos, stored, since, order_by, lookback_days, known)
    report, as_of = write_silver(change, rows, fmt, since)
    newest = change.read(SILVER)
    if as_of is None:  # every date from ``since`` on was emptied
        as_of = newest.agg(F.max("transaction_date")).first()[0]
    change.write(report, QUALITY, keep=lambda part: True, fmt=fmt)
    if known is None:
        write_tail(change, without_demand(newest), as_of, fmt)
    elif as_of is not None and as_of.isoformat() in kept:  # what is left ends where a tail does
        change.parts[TAIL] = [p for p in change.parts[TAIL] if p[1] in kept]
    else:
        later = newest.where(F.col("transaction_date") >= F.lit(since)).select(*POS.names, *DEMAND)
        write_tail(change, known.unionByName(without_demand(later)), as_of, fmt, kept)
    _derive(change, bronze, stores, skus, fmt, as_of, since, **rules)
    if FIRSTS in change.parts:
        _write_panel(change, as_of, fmt, since)
    change.publish()
    return tables
