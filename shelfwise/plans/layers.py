"""Bronze, silver and gold as pure functions of DataFrames."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.functions import days_of_supply, status
from shelfwise.operators import dedup, on_latest_date, on_latest_per_pair, rolling_mean
from shelfwise.schemas import CELL, LONG_FRAME, PAIR, POS, REORDER_DAYS, SHORT_FRAME, WATCH_DAYS

FRAMES = {"avg_daily_demand_7d": SHORT_FRAME, "avg_daily_demand_14d": LONG_FRAME}
# Marks the last row of a pair in a stored tail.
IS_LAST = "is_last"


def bronze(pos: DataFrame) -> DataFrame:
    """The declared POS columns, typed."""
    return pos.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in POS])


def with_demand(rows: DataFrame) -> DataFrame:
    """Silver columns of deduplicated rows."""
    return rows.select(
        *POS.names, *[rolling_mean("qty_sold", size).alias(name) for name, size in FRAMES.items()])


def silver(pos: DataFrame, order_by: Sequence | None = None, *, colocate: bool = False) -> DataFrame:
    """One row per store, SKU and date with trailing 7- and 14-row demand.

    Two shuffles by default: duplicates are cut on the map side and meet on
    (store, SKU, date), so after the first shuffle no pair holds more rows than
    there are dates, however many copies came in. They are sent sorted by those keys, without
    a hash, so that neighbours are alike and compress well. ``colocate=True`` ships raw
    rows by pair instead and needs one shuffle and one sort for both steps; use
    it only where no single pair holds a large share of the raw rows.
    """
    if colocate:
        pos = pos.repartition(*PAIR)
    return with_demand(dedup(pos, order_by=order_by, hash_first=False))


def tail_rows(rows: DataFrame) -> DataFrame:
    """The last 13 rows of every pair: all that frames of later rows can reach."""
    newest = Window.partitionBy(*PAIR).orderBy(F.desc("transaction_date"))
    ranked = rows.withColumn("_rn", F.row_number().over(newest))
    return ranked.where(F.col("_rn") <= LONG_FRAME - 1).drop("_rn")


def without_demand(rows: DataFrame) -> DataFrame:
    """Silver rows without the demand that :func:`stored_tail` finds from the quantities: that of rows with both keys."""
    keyless = F.col("store_id").isNull() | F.col("sku_id").isNull()
    return rows.withColumns({name: F.when(keyless, F.col(name)) for name in FRAMES})


def stored_tail(rows: DataFrame) -> DataFrame:
    """The last 13 rows of every pair, with stock and demand of the last one alone, which is marked and gives its signal.

    ``rows`` are a stored tail and the rows after it, or 14 rows of every pair that has them. Demand that they lack is the
    mean of the last quantities; frames of rows without a store or a SKU may have started later, so these bring theirs.
    """
    newest = Window.partitionBy(*PAIR).orderBy(F.desc("transaction_date"))
    last = rows.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= LONG_FRAME)
    keyless, is_last = F.col("store_id").isNull() | F.col("sku_id").isNull(), F.col("_rn") == 1
    means = {name: F.avg("qty_sold").over(newest.rowsBetween(Window.currentRow, size - 1)) for name, size in FRAMES.items()}
    return last.withColumns({
        IS_LAST: is_last,
        "inventory_on_hand": F.when(is_last, F.col("inventory_on_hand")),
        **{name: F.when(is_last, F.when(keyless, F.col(name)).otherwise(F.coalesce(F.col(name), mean)))
           for name, mean in means.items()},
    }).where(F.col("_rn") <= LONG_FRAME - 1).drop("_rn")


def carried_rows(
    stored: DataFrame, pairs: DataFrame, since: datetime.date, lookback_days: int
) -> DataFrame:
    """The rows before ``since`` that frames of later rows can reach: 13 per pair.

    Most pairs have them within ``lookback_days``, and only those partitions are
    read for them. Pairs that are short there are looked up in all older dates;
    where none is, AQE drops that scan.
    """
    reach = LONG_FRAME - 1
    day = F.col("transaction_date")
    edge = F.lit(since - datetime.timedelta(days=lookback_days))
    before = stored.select(*POS.names).where(day < F.lit(since))
    recent = before.where(day >= edge).join(pairs, PAIR, "left_semi")
    complete = recent.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= reach)
    short = pairs.join(complete, PAIR, "left_anti")
    older = before.where(day < edge).join(short, PAIR, "left_semi")
    return tail_rows(recent.unionByName(older))


def silver_since(
    pos: DataFrame,
    stored: DataFrame,
    since: datetime.date,
    order_by: Sequence | None = None,
    lookback_days: int = 28,
    before: DataFrame | None = None,
) -> DataFrame:
    """The silver rows from ``since`` on, given the stored silver of earlier dates.

    Equal to those dates of ``silver(pos)`` as long as no row before ``since``
    has changed, and reads of ``pos`` only the dates from there. ``before`` holds the rows before
    ``since`` where they are known, at least each pair's last 13; ``stored`` is not read then. They meet the new rows in
    the shuffle of the frames, without a join before it; of pairs that have no new row, all rows lie before ``since``.
    Rows of a pair without a store or a SKU are not carried over, and of the others only what frames take.
    """
    day = F.col("transaction_date")
    fresh = dedup(pos.where(day >= F.lit(since)), order_by=order_by, hash_first=False).select(*POS.names)
    if before is None:
        carried = carried_rows(stored, fresh.select(*PAIR).distinct(), since, lookback_days)
    else:
        carried = before.select(*POS.names).na.drop(subset=PAIR)
    rows = fresh.unionByName(carried.select(*CELL, "qty_sold"), allowMissingColumns=True)
    return with_demand(rows).where(day >= F.lit(since))


def signals(
    rows: DataFrame,
    *,
    reorder_days: float = REORDER_DAYS,
    watch_days: float = WATCH_DAYS,
    zero_demand_policy: str = "ok",
) -> DataFrame:
    """Gold columns for every given silver row. Status tests the unrounded ratio."""
    inventory, demand = F.col("inventory_on_hand"), F.col("avg_daily_demand_7d")
    rated = rows.withColumn("_ratio", days_of_supply(inventory, demand))
    return rated.select(
        *PAIR,
        "inventory_on_hand",
        F.round("avg_daily_demand_7d", 1).alias("avg_daily_demand_7d"),
        F.round("avg_daily_demand_14d", 1).alias("avg_daily_demand_14d"),
        F.round("_ratio", 1).alias("days_of_supply"),
        status(
            F.col("_ratio"), inventory, reorder_days=reorder_days, watch_days=watch_days,
            zero_demand_policy=zero_demand_policy,
        ).alias("replenishment_status"),
        F.col("transaction_date").alias("signal_date"),
    )


def gold(
    silver_rows: DataFrame,
    dates: DataFrame | None = None,
    *,
    as_of: datetime.date | None = None,
    latest: str = "global",
    **rules,
) -> DataFrame:
    """Signals at the latest date.

    ``global`` keeps pairs that have a row on the one latest date; ``per_key``
    keeps every pair at its own latest date. ``dates`` and ``as_of`` are passed
    on to :func:`on_latest_date`, ``rules`` to :func:`signals`.
    """
    if latest == "global":
        rows = on_latest_date(silver_rows, dates, as_of)
    elif latest == "per_key":
        rows = on_latest_per_pair(silver_rows)
    else:
        raise ValueError("latest must be 'global' or 'per_key'")
    return signals(rows, **rules)


def signal_history(silver_rows: DataFrame, **rules) -> DataFrame:
    """Signals for every date."""
    return signals(silver_rows, **rules)
