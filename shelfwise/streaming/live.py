"""Signals kept current by micro-batches.

A pair's signal depends only on its 14 most recent deduplicated rows: older rows lie outside both
frames, also when late rows arrive. So the state is at most 14 rows per pair, whatever the
history, and it merges: the recent rows of a union are the recent rows of the parts' recent rows.

The state is Spark's own keyed state: pairs are dealt to ``buckets`` by hash, and one state value holds the rows of a
bucket's pairs, packed as a compressed Arrow message. A micro-batch reads and writes the buckets of the pairs that it
touches and no others, so its cost follows its own rows, not the number of pairs. Versions, replays and recovery are those
of the query's checkpoint. Before the shuffle every task merges its own rows in the same way, so a pair with a third of
a batch sends 14 rows for each task.

Rows stay in columns from the file to the signals: a merge sorts arrays and no row is a Python object. They are sorted
as Spark sorts them: nulls first, NaN last, text by its bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shelfwise.plans.layers import gold, with_demand
from shelfwise.schemas import CELL, LONG_FRAME, PAIR, POS
from shelfwise.streaming.slots import last_batch, read_slots, write_slot

BUCKETS = 4096
KEPT = 20  # batches whose changed signals stay stored
HELD = 1_000_000  # rows that a task merges before it hands them on
PACKED = "rows binary"


def _ranks(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Arrays whose order, the first one first, is Spark's ascending order of a column's values."""
    values = column.combine_chunks()
    kind, valid = values.type, np.asarray(values.is_valid()) if values.null_count else None
    if pa.types.is_floating(kind):
        numbers = values.fill_null(0.0).to_numpy(zero_copy_only=False)
        nan = np.isnan(numbers)
        place = np.ones(len(numbers), np.int8) if valid is None else valid.astype(np.int8)
        return [place + nan, np.where(nan, 0.0, numbers)]
    if pa.types.is_date32(kind):
        values = values.cast(pa.int32())
    if pa.types.is_integer(values.type):
        numbers = values.fill_null(0).to_numpy(zero_copy_only=False)
        return [numbers] if valid is None else [valid, numbers]
    return [np.asarray(pc.rank(values, null_placement="at_start", tiebreaker="dense"))]


def _starts(ranks: Sequence[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Which of the sorted rows differ from the one before them."""
    out = np.zeros(len(order), bool)
    out[:1] = True
    for rank in ranks:
        sorted_rank = rank[order]
        out[1:] |= sorted_rank[1:] != sorted_rank[:-1]
    return out


def _recent(rows: pa.Table, order: Sequence[str], late: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are the last ``LONG_FRAME`` deduplicated ones of their pairs, and which of these belong to a pair that
    has a row from position ``late`` on."""
    pair, date, rest = ([r for c in columns for r in _ranks(rows[c])] for columns in (PAIR, ["transaction_date"], order))
    by = np.lexsort([*reversed(rest), *reversed(date), *reversed(pair)])
    first_of_pair = _starts(pair, by)
    kept = np.flatnonzero(first_of_pair | _starts(date, by))  # the smallest row of every cell
    pair_of = np.cumsum(first_of_pair) - 1
    touched = np.zeros(pair_of[-1] + 1 if len(by) else 0, bool)
    touched[pair_of[by >= late]] = True
    cell_pair = pair_of[kept]
    after = np.searchsorted(cell_pair, cell_pair, "right") - np.arange(len(kept))  # cells of the pair from this one on
    kept, cell_pair = kept[after <= LONG_FRAME], cell_pair[after <= LONG_FRAME]
    return by[kept], touched[cell_pair]


class RecentRows:
    """The last ``LONG_FRAME`` deduplicated rows of every pair of a set of rows."""

    def __init__(self, columns: Sequence[str], order: Sequence[str]):
        self._columns, self._order = list(columns), list(order)
        self.table: pa.Table | None = None

    def add(self, rows: pa.Table | Iterable[tuple]) -> pa.Table:
        """Merges rows in, a table or tuples of ``columns``; the recent rows, after it, of the pairs that they belong to."""
        if not isinstance(rows, pa.Table):
            rows = pa.table([pa.array(values) for values in zip(*rows)], self._columns)
        before = self.table.num_rows if self.table is not None else 0
        if before:
            rows = pa.concat_tables([self.table, rows], promote_options="permissive")
        kept, touched = _recent(rows, [c for c in self._order if c in rows.column_names], before)
        self.table = rows.take(kept).combine_chunks()
        return self.table if touched.all() else self.table.filter(pa.array(touched))

    def rows(self) -> list[tuple]:
        return [] if self.table is None else list(zip(*(c.to_pylist() for c in self.table.columns)))


def _pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpack(packed: Iterable[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(message).read_all() for message in packed])


def _unpacked(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of packed ones."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for message in batch.column(0):
                yield from pa.ipc.open_stream(message.as_buffer()).read_all().select(schema.names).to_batches()

    return rows.mapInArrow(unpack, schema)


class LiveSignals:
    """Signals of a stream; batches' changes are stored under ``root``, the state in the query's checkpoint."""

    def __init__(
        self, spark: SparkSession, root: str, order_by: Sequence[str] | None = None,
        buckets: int = BUCKETS, kept: int = KEPT, **rules,
    ):
        self.spark, self.root, self.buckets, self.kept = spark, root.rstrip("/"), buckets, kept
        self.order_by, self.rules = order_by, rules

    def recent(self, stream: DataFrame) -> DataFrame:
        """For every micro-batch the recent rows of the pairs that it touches, after it."""
        order = list(self.order_by or [c for c in stream.columns if c not in CELL])
        columns = [*POS.names, *[c for c in order if c not in POS.names]]
        schema = T.StructType([stream.schema[c] for c in columns])

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, waiting, count = RecentRows(["bucket", *columns], order), [], 0

            def out() -> pa.RecordBatch:
                rows = held.table.sort_by("bucket")
                buckets = rows["bucket"].to_numpy()
                starts = np.flatnonzero(np.diff(buckets, prepend=buckets[0] - 1))
                rows, ends = rows.drop_columns("bucket"), [*starts[1:], len(buckets)]
                packed = [_pack(rows.slice(a, b - a)) for a, b in zip(starts, ends)]
                return pa.RecordBatch.from_arrays([pa.array(buckets[starts]), pa.array(packed, pa.binary())], ["bucket", "rows"])

            for batch in batches:
                waiting.append(batch)
                count += batch.num_rows
                if count >= HELD:
                    held.add(pa.Table.from_batches(waiting))
                    waiting, count = [], 0
                    if held.table.num_rows >= HELD // 2:
                        yield out()
                        held = RecentRows(["bucket", *columns], order)
            if count:
                held.add(pa.Table.from_batches(waiting))
            if held.table is not None and held.table.num_rows:
                yield out()

        def update(key: tuple, frames: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
            held = RecentRows(columns, order)
            if kept.exists:
                held.table = _unpack(kept.get)
            touched = held.add(_unpack(message for frame in frames for message in frame["rows"]))
            kept.update((_pack(held.table),))
            yield pd.DataFrame({"rows": [_pack(touched)]})

        bucket = F.pmod(F.xxhash64(*PAIR), F.lit(self.buckets)).alias("bucket")
        packed = (stream.select(bucket, *columns).mapInArrow(merge, f"bucket long, {PACKED}")
                  .groupBy("bucket").applyInPandasWithState(update, PACKED, PACKED, "append", GroupStateTimeout.NoTimeout))
        return _unpacked(packed, schema)

    def _store(self, rows: DataFrame, batch_id: int) -> None:
        """The signals of the pairs that a batch touched."""
        signals = gold(with_demand(rows), latest="per_key", **self.rules)
        write_slot(signals, f"{self.root}/signals", batch_id, self.kept)

    def start(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        return self.recent(stream).writeStream.foreachBatch(self._store).option("checkpointLocation", checkpoint)

    def last_batch(self) -> int:
        """The last batch that touched a pair, also after a restart that found nothing new."""
        return last_batch(self.spark, f"{self.root}/signals")

    def changed(self, batch_id: int) -> DataFrame:
        """The signals of the pairs that a batch touched; the newest ``kept`` batches are there."""
        return read_slots(self.spark, f"{self.root}/signals", batch_id, batch_id)

    def state(self, checkpoint: str, batch_id: int | None = None) -> DataFrame:
        """The state's rows, as of a batch that the checkpoint still holds, by default the last."""
        reader = self.spark.read.format("statestore")
        if batch_id is not None:
            reader = reader.option("batchId", batch_id)
        packed = reader.load(checkpoint).select("value.groupState.rows")
        first = packed.head()
        schema = from_arrow_schema(pa.ipc.open_stream(first[0]).schema) if first else POS
        return _unpacked(packed, schema)

    def current(self, checkpoint: str, batch_id: int | None = None, latest: str = "per_key") -> DataFrame:
        """All signals as of a batch.

        ``global`` matches the batch gold, but a new date empties it of pairs
        that have not reported yet; ``per_key`` keeps them.
        """
        rows = self.state(checkpoint, batch_id)
        return gold(with_demand(rows), rows, latest=latest, **self.rules)
