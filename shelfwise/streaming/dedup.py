"""Streaming keyed dedup: a store of cells that loses nothing, and a closing variant.

:class:`CellStore` is the one that equals the batch. :func:`closed_cells` emits each date once
and drops what comes later than its delay.
"""

from __future__ import annotations

import datetime
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from shelfwise.operators import dedup
from shelfwise.schemas import CELL, PAIR, POS
from shelfwise.streaming.slots import last_batch, read_slots, write_slot

CLOSING_DELAY = "2 days"


def closed_cells(
    stream: DataFrame, order_by: Sequence[str] | None = None, delay: str = CLOSING_DELAY
) -> DataFrame:
    """One row per store, SKU and date, emitted once the date has closed.

    A date closes when the newest date seen is ``delay`` past it; rows that come
    after its cells were emitted are dropped, and state holds open dates only. The survivor is
    the smallest row by ``order_by``, the same one the batch dedup keeps, not the
    first to arrive. As an aggregation it merges copies before the shuffle.
    """
    order = list(order_by) if order_by else [c for c in stream.columns if c not in CELL]
    payload = [c for c in POS.names if c not in CELL and c not in order]
    day = F.col("transaction_date").cast("timestamp").alias("day")
    kept = (
        stream.select(day, *PAIR, F.struct(*order, *payload).alias("row"))
        .withWatermark("day", delay)
        .groupBy("day", *PAIR)
        .agg(F.min("row").alias("row"))
    )
    return kept.select(
        "day", *PAIR, F.col("day").cast("date").alias("transaction_date"),
        *[F.col(f"row.{c}").alias(c) for c in POS.names if c not in CELL],
    )


class CellStore:
    """Deduplicated cells kept by micro-batches, equal to the batch dedup however the input is cut.

    Batch K stores its own rows in a slot of ``recent``, unshuffled; the table is the dedup of the union, since the smallest
    of smallest rows is the smallest. Every ``compact_every`` batches, a generation, its cells merge into
    ``cells``, by date: a date has two versions at most, and a merge rewrites, of the dates that its generation
    touches, the version that is not in use. Which version counts is kept in a small table per
    generation, by date, the newest two of them. So readers of the generation before are not disturbed, a
    replayed batch or merge writes the same again, untouched dates are neither read nor written, and the number of
    folders is bounded by slots and dates.
    """

    def __init__(self, spark: SparkSession, root: str, order_by: Sequence[str] | None = None, compact_every: int = 10):
        self.spark, self.root, self.compact_every = spark, root.rstrip("/"), compact_every
        self.order_by = order_by

    def process(self, batch: DataFrame, batch_id: int) -> None:
        write_slot(batch, f"{self.root}/recent", batch_id, 2 * self.compact_every)
        if (batch_id + 1) % self.compact_every == 0:
            self._merge(batch_id // self.compact_every)

    def start(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)

    def current(self, batch_id: int | None = None, dates: Collection[datetime.date] | None = None) -> DataFrame:
        """All cells as of a batch, by default the last one stored; with ``dates`` those of these dates."""
        last = last_batch(self.spark, f"{self.root}/recent") if batch_id is None else batch_id
        generation = last // self.compact_every
        rows = read_slots(self.spark, f"{self.root}/recent", generation * self.compact_every, last)
        if dates is not None:
            rows = rows.where(_on(dates))
        merged = self._merged(self.versions(generation - 1), dates)
        rows = rows if merged is None else rows.unionByName(merged)
        return dedup(rows, CELL, self.order_by).select(*POS.names)

    def merged(self, batch_id: int, dates: Collection[datetime.date]) -> DataFrame | None:
        """The cells of these dates as of a batch whose merge has ended a generation: as stored, without a dedup."""
        if (batch_id + 1) % self.compact_every:
            return None
        cells = self._merged(self.versions(batch_id // self.compact_every), dates)
        return None if cells is None else cells.select(*POS.names)

    def versions(self, generation: int) -> dict[datetime.date, int]:
        """The version of every merged date after a generation: one entry per date."""
        if generation < 0:
            return {}
        rows = self.spark.read.parquet(f"{self.root}/versions/slot={generation % 2}").where(F.col("generation") == generation).collect()
        return {row["transaction_date"]: row["version"] for row in rows if row["transaction_date"] is not None or row["version"] is not None}

    def _merged(self, versions: dict[datetime.date, int], dates: Collection[datetime.date] | None) -> DataFrame | None:
        wanted = versions.keys() if dates is None else versions.keys() & set(dates)
        if not wanted:
            return None
        each = [F.col("version").eqNullSafe(v) & _on([d for d in wanted if versions[d] == v]) for v in (0, 1)]
        return self.spark.read.parquet(f"{self.root}/cells").where(each[0] | each[1]).drop("version")

    def _merge(self, generation: int) -> None:
        first = generation * self.compact_every
        recent = read_slots(self.spark, f"{self.root}/recent", first, first + self.compact_every - 1)
        touched = {row[0] for row in recent.select("transaction_date").distinct().collect()}
        before = self.versions(generation - 1)
        after = before | {date: 1 - before.get(date, 1) for date in touched}
        merged = self._merged(before, touched)
        rows = dedup(recent if merged is None else recent.unionByName(merged), CELL, self.order_by)
        second = F.coalesce(_on([d for d in touched if after[d] == 1]), F.lit(False))
        # A task writes a file for each of its dates; gathering them would ship every cell a second time.
        (rows.withColumn("version", second.cast("int"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("transaction_date", "version").parquet(f"{self.root}/cells"))
        # A row without date and version stands for a generation that has no dates.
        lines = [(date, version, generation) for date, version in after.items()] or [(None, None, generation)]
        self.spark.createDataFrame(lines, "transaction_date date, version int, generation int").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.root}/versions/slot={generation % 2}")


def _on(dates: Collection[datetime.date | None]) -> Column:
    """Rows of these dates; None stands for rows without one."""
    known = [F.lit(d) for d in dates if d is not None]
    day = F.col("transaction_date")
    found = day.isin(known) if known else F.lit(False)
    return found | day.isNull() if None in dates else found
