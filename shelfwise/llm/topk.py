"""Exact top-k by inner product over a bit-sliced index.

A component x becomes the whole number ``floor(1024 x)``. The index cuts the rows into blocks
and stores of each block, for every component and every bit of its value above the
block's least, one bitmap over the rows. Values wider than ``SLICES`` bits keep their highest ones.

For a batch of queries the weighted components are added up on bitmaps alone: each set bit of
a weight adds the component's slices, shifted, with ripple carry; a negative weight
adds the complements instead. The k best rows are then selected from the most significant
slice of the sum downwards. Since low bits were left out, every row within
the largest possible error of the k-th stays as well, and these boundary rows are
resolved on the full values.

Vectors with components of ``2**BITS`` and more are cut to their highest ``BITS`` bits for the index, in blocks of
their own, and so are such queries; what that leaves out widens the boundary, whose rows are resolved in whole numbers
of any size. Scores that a long can't hold are ranked by their exact value and returned as the nearest long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.common import stored

SCALE, K, EVERY = 1024, 10, 100
BLOCK = 2048     # rows
BATCH = 128      # queries that go through a block together
CELLS = 512      # of the grid in which blocks and batches of queries meet
SLICES = 8       # bits of a component that the index keeps
BITS = 23        # of a component that sums are made of, so that none leaves 64 bits
ALL = np.uint64(2**64 - 1)
LEAST_LONG, MOST_LONG = -2**63, 2**63 - 1


def usable(vector: Column) -> Column:
    """Vectors that are not null, not empty and hold finite components only, also when scaled."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * SCALE) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, values`` of the rows that take part; the values are whole numbers of any size, as doubles."""
    def whole(x: Column) -> Column:
        scaled = x.cast("double") * SCALE
        return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)

    return (rows.where(usable(F.col(vector)) & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(F.col(vector), whole).alias("values")))


def cuts(values: np.ndarray) -> np.ndarray:
    """How many low bits each vector loses so that its components stay below ``2**BITS``: a multiple of 8."""
    exponent = np.frexp(np.abs(values).max(axis=1, initial=0))[1]
    return -(-np.maximum(0, exponent - BITS) // 8) * 8


def shortened(values: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.floor(np.ldexp(values, -by[:, None])).astype(np.int64)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in 16 or 32 bits, if all fit, or as doubles."""
    most = np.abs(values).max(initial=0)
    return values.astype("<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8").tobytes()


def unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(data, {2: "<i2", 4: "<i4", 8: "<f8"}[len(data) // (rows * width)]).reshape(rows, width)


def _matrix(batch: pa.RecordBatch, name: str = "values") -> list[np.ndarray]:
    """The vectors of a batch as one matrix for each number of components."""
    column = batch.column(name)
    flat, offsets = column.flatten().to_numpy(), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    widths = np.diff(offsets)
    return [(np.flatnonzero(widths == w),
             flat[(offsets[:-1][widths == w][:, None] + np.arange(w)[None, :])].astype(np.float64))
            for w in np.unique(widths)]


def index(vectors: DataFrame, block: int = BLOCK, slices: int = SLICES) -> DataFrame:
    """``width, rows, cut, shift, reach, ids, bits, values``: the blocks; every row is in one.

    Blocks are cut from the rows as they are read, which needs no shuffle and gives equal
    blocks however often an id or a vector occurs. Rows of a block have lost equally many low bits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for at, values in _matrix(batch):
                by = cuts(values)
                for cut in np.unique(by):
                    key = values.shape[1], int(cut)
                    parts = held.setdefault(key, [])
                    parts.append((ids[at[by == cut]], values[by == cut]))
                    if sum(len(p[0]) for p in parts) >= block:
                        ids_all, values_all = (np.concatenate(x) for x in zip(*parts))
                        whole = len(ids_all) // block * block
                        for a in range(0, whole, block):
                            yield _block(ids_all[a:a + block], values_all[a:a + block], slices, int(cut))
                        held[key] = [(ids_all[whole:], values_all[whole:])]
        for (_, cut), parts in held.items():
            ids_all, values_all = (np.concatenate(x) for x in zip(*parts))
            if len(ids_all):
                yield _block(ids_all, values_all, slices, cut)

    return vectors.mapInArrow(
        run, "width int, rows int, cut int, shift int, reach bigint, ids binary, bits binary, values binary")


def _block(ids: np.ndarray, values: np.ndarray, slices: int, cut: int) -> pa.RecordBatch:
    """Whole values are kept beside the slices. ``reach`` bounds a row's sum of sizes."""
    small = shortened(values, np.full(len(values), cut))
    above = small - small.min(axis=0)
    shift = max(0, int(above.max()).bit_length() - slices)
    bits = slices_of(above >> shift, min(slices, max(1, int(above.max() >> shift).bit_length())))
    return pa.RecordBatch.from_arrays([
        pa.array([values.shape[1]], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([cut], pa.int32()),
        pa.array([shift], pa.int32()), pa.array([int(np.abs(small).sum(axis=1).max())], pa.int64()),
        pa.array([ids.astype("<i8").tobytes()]), pa.array([bits.tobytes()]), pa.array([packed(values)]),
    ], names=["width", "rows", "cut", "shift", "reach", "ids", "bits", "values"])


def slices_of(values: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps over the rows, by component and bit: shape (components, bits, words)."""
    rows, width = values.shape
    words = -(-rows // 64)
    out = np.zeros((width, bits, words * 64), np.uint8)
    for b in range(bits):
        out[:, b, :rows] = ((values >> b) & 1).T
    return np.packbits(out, axis=2, bitorder="little").view("<u8")


def _add(total: list[np.ndarray], at: int, addend: list[np.ndarray], fresh) -> None:
    """Adds slices to the sum from slice ``at`` on, with ripple carry; the sum grows as needed."""
    carry = None
    for i, a in enumerate(addend):
        while len(total) <= at + i:
            total.append(fresh())
        t = total[at + i]
        half = t ^ a
        if carry is None:
            total[at + i], carry = half, t & a
        else:
            total[at + i], carry = half ^ carry, (t & a) | (half & carry)
    i = at + len(addend)
    while carry.any():
        if len(total) <= i:
            total.append(fresh())
        total[i], carry = total[i] ^ carry, total[i] & carry
        i += 1


def sums(bitmaps: np.ndarray, weights: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Slices of the weighted sums, each (queries, words), and what to add to each query's sum.

    Sum over components of weight times value; a weight w < 0 counts as |w| times the complement.
    """
    width, bits, words = bitmaps.shape
    top = (1 << bits) - 1
    fresh = lambda: np.zeros((len(weights), words), np.uint64)
    total: list[np.ndarray] = []
    size = np.abs(weights)
    for c in range(width):
        flip = np.where(weights[:, c] < 0, ALL, np.uint64(0))[:, None]
        turned = [bitmaps[c, b][None, :] ^ flip for b in range(bits)]
        for j in range(int(size[:, c].max(initial=0)).bit_length()):
            mask = np.where((size[:, c] >> j) & 1, ALL, np.uint64(0))[:, None]
            if mask.any():
                _add(total, j, [t & mask for t in turned], fresh)
    return total, (np.minimum(weights, 0) * top).sum(axis=1)


def select(total: list[np.ndarray], alive: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """For one query: the sum of its k-th best row (the least sum, if there are fewer rows).

    From the most significant slice down: if the rows with the bit set are at least as many as
    are still wanted, only they stay; otherwise they are in, and the rest competes for what is left.
    """
    wanted, found = k, 0
    for slice_ in reversed(total):
        with_bit = alive & slice_
        n = int(np.bitwise_count(with_bit).sum())
        found <<= 1
        if n >= wanted:
            alive, found = with_bit, found | 1
        else:
            wanted -= n
            alive = alive & ~slice_
    return alive, found


def _plain(total: list[np.ndarray], query: int, rows: int) -> np.ndarray:
    out = np.zeros(rows, np.int64)
    for i, slice_ in enumerate(total):
        bits = np.unpackbits(slice_[query].view(np.uint8), bitorder="little")[:rows]
        out += bits.astype(np.int64) << i
    return out


def exact_scores(values: np.ndarray, weights: np.ndarray) -> list[int]:
    """Inner products in whole numbers of any size."""
    whole = [int(w) for w in weights]
    return [sum(int(v) * w for v, w in zip(row, whole)) for row in values]


def best_in_block(block: dict, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """For each query its k best rows of the block: query number, ids, scores. ``own`` are the queries' ids."""
    rows, width, shift, cut = block["rows"], block["width"], block["shift"], block["cut"]
    ids = np.frombuffer(block["ids"], "<i8")
    values = unpacked(block["values"], rows, width)
    words = -(-rows // 64)
    bitmaps = np.frombuffer(block["bits"], "<u8").reshape(width, -1, words)
    lost = cuts(queries)
    weights = shortened(queries, lost)
    total, _ = sums(bitmaps, weights)
    filled = np.zeros(words * 64, np.uint8)
    filled[:rows] = 1
    for q in range(len(queries)):
        mask = filled.copy()
        mask[:rows][ids == own[q]] = 0
        n = int(mask.sum())
        if not n:
            continue
        alive = np.packbits(mask, bitorder="little").view("<u8")
        mine = [t[q] for t in total]
        _, kth = select(mine, alive, min(k, n))
        # Bits that the slices leave out move a sum by less than the query's size, either way.
        size = int(np.abs(weights[q]).sum())
        slack = size if shift else 0
        # A cut component lacks less than 1 of its short form: as much as its partner's size, and 1 where both are cut.
        missing = (size if cut else 0) + (block["reach"] if lost[q] else 0) + (width if cut and lost[q] else 0)
        slack += -(-2 * missing >> shift)
        rough = _plain(total, q, rows)
        at = np.flatnonzero((rough >= kth - slack) & (mask[:rows] > 0))
        if cut or lost[q]:
            scores = exact_scores(values[at], queries[q])
            order = sorted(range(len(at)), key=lambda i: (-scores[i], ids[at[i]]))[:k]
            yield q, [int(ids[at[i]]) for i in order], [scores[i] for i in order]
        else:
            scores = values[at].astype(np.int64) @ weights[q]
            order = np.lexsort((ids[at], -scores))[:k]
            yield q, ids[at][order].tolist(), scores[order].tolist()


def beyond(score: int) -> bytes:
    """Orders scores as bytes: one value for all that a long holds, and above or below it the others by size."""
    if LEAST_LONG <= score <= MOST_LONG:
        return b"\x80"
    size = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    text = len(size).to_bytes(2, "big") + size
    return b"\x81" + text if score > 0 else b"\x7f" + bytes(255 - b for b in text)


def top(vectors: DataFrame, queries: DataFrame, k: int = K, blocks: DataFrame | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the highest inner product for each query.

    ``vectors`` and ``queries`` have ``vec_id, values`` (see :func:`whole_vectors`). A query's own id
    is no candidate, nor are rows with another number of components. Ties go to the smaller id; fewer
    rows than k give them all; a query row that occurs twice is answered twice. Scores beyond 64 bits are
    ranked by their exact value and returned as the nearest long.
    """
    blocks = stored(index(vectors), "blocks") if blocks is None else blocks

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers = batch.column("vec_id").to_numpy(), batch.column("number").to_numpy()
            for at, values in _matrix(batch):
                for a in range(0, len(at), BATCH):
                    part = at[a:a + BATCH]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([values.shape[1]], pa.int32()), pa.array([numbers[part].astype("<i8").tobytes()]),
                        pa.array([ids[part].astype("<i8").tobytes()]), pa.array([packed(values[a:a + BATCH])]),
                    ], names=["width", "numbers", "own", "weights"])

    asked = stored(queries.withColumn("number", F.monotonically_increasing_id()), "queries")
    tasks = max(1, min(asked.rdd.getNumPartitions(), asked.count() // BATCH))
    batches = stored(asked.coalesce(tasks).mapInArrow(
        gather, "width int, numbers binary, own binary, weights binary"), "batches")

    def search(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for row in frame.to_pylist():
                own = np.frombuffer(row["own"], "<i8")
                weights = unpacked(row["weights"], len(own), row["width"]).astype(np.float64)
                numbers = np.frombuffer(row["numbers"], "<i8").tolist()
                found = [(numbers[q], int(own[q]), i, min(max(score, LEAST_LONG), MOST_LONG), beyond(score))
                         for q, ids, scores in best_in_block(row, weights, own, k) for i, score in zip(ids, scores)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*found)], names=["number", "query_id", "vec_id", "score", "beyond"])

    # Every batch of queries meets every block of its width: blocks times batches rows, no pairs. They are
    # dealt to a grid, blocks copied along its rows and batches along its columns, so that few bytes are copied
    # however many there are of either: a block takes about as much as 12 batches with their answers. The join is by shuffle
    # and has a hint, as Spark takes the copies for as large as one: it would broadcast up to 512 times its threshold.
    n, m = max(1, blocks.count()), max(1, batches.count())
    down = max(1, min(n, CELLS, round(math.sqrt(CELLS * 12 * n / m))))
    across = max(1, min(m, CELLS // down))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))
    blocks = blocks.withColumn("down", F.pmod(F.xxhash64("ids"), F.lit(down))).withColumn("across", every(across))
    batches = batches.withColumn("across", F.pmod(F.xxhash64("numbers"), F.lit(across))).withColumn("down", every(down))
    cell, cells = ["width", "down", "across"], down * across
    met = blocks.repartition(cells, *cell).hint("merge").join(batches.repartition(cells, *cell), cell).select(
        "width", "rows", "cut", "shift", "reach", "ids", "bits", "values", "numbers", "own", "weights")
    hits = met.mapInArrow(search, "number bigint, query_id bigint, vec_id bigint, score bigint, beyond binary")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
