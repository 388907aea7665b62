"""Hard negatives by angular triangle filtering.

A component x becomes the whole number ``floor(256 x)``; a score is the inner product of whole numbers. Each row stores
its angles to a few reference directions. For an anchor a, a row x and a reference r the angle between a and x
lies between ``|(a,r) - (x,r)|`` and ``(a,r) + (x,r)``, so its cosine lies within
``cos(a,r) cos(x,r) -+ sin(a,r) sin(x,r)``. The tightest such interval over the references, widened by
``SLACK`` for all rounding and multiplied by both norms, bounds the score. Rows are scored in whole
numbers only where that interval meets what is asked for:

* for positives, what the fifth best lower bound of the same label leaves open;
* for negatives, the window between half and 95 % of a positive's score. Where a double holds every score, the rows that any
  anchor of a batch may need are scored by one product of matrices for all its anchors and positives; beyond that, row by
  row above the third best lower bound among rows that are certainly inside the window.

References are the centres of a bounded sample (``SAMPLE`` rows); they decide how many rows are scored, never which
result comes out. Rows are sorted by label and nearest reference and cut into blocks;
batches of anchors meet all blocks of their width, dealt by the blocks' numbers, so no label or vector is a key.

Rows without id, label or vector, or with a null or non-finite component, take no part; rows of different numbers
of components do not meet. Repeated anchors are answered once each, and repeated rows are candidates of their own,
though never for their own id. Scores of up to 37 digits are compared exactly; returned ones end at the
limits of a long. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.common import stored

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 50, 5, 3
LOW, HIGH = (1, 2), (19, 20)  # of a positive's score: the window of its negatives
REFERENCES, SAMPLE = 16, 512
BLOCK, BATCH = 1024, 128      # rows; anchors that go through a block together
GROUP = 16                    # blocks that a batch of anchors is sent to together
SLACK = 4e-6                  # of a cosine: angles are stored in 32 bits, each within 3e-7
WILD = 2.0**200               # of a whole component: beyond, no bound is tried
SPLIT = 62                    # a score is high * 2**62 + low
ROW = "number long, vec_id long, label long, values array<double>"
PACKED = ("width int, rows int, first long, last long, numbers binary, ids binary, labels binary, values binary, "
          "norms binary, angles binary")
HIT = "number long, anchor_id long, positive int, positive_id long, p_high long, p_low long, vec_id long, high long, low long"


def participants(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``number, vec_id, label, values`` of the rows that take part, with the labels that mining goes by."""
    vec_id, label = F.col("vec_id").cast("bigint"), F.col("label").cast("bigint")
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return (rows.where(vec_id.isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & fine)
            .select(F.monotonically_increasing_id().alias("number"), vec_id.alias("vec_id"), moved.alias("label"),
                    F.col(vector).cast("array<double>").alias("values")))


def references(rows: DataFrame, count: int = REFERENCES, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Unit directions by number of components: the centres of ``sample`` rows, those with the smallest hashes."""
    order = F.xxhash64("vec_id", "number")
    picked = rows.select("values", order.alias("h")).orderBy("h").limit(sample).toArrow().column("values").to_pylist()
    by: dict[int, list] = {}
    for values in picked:
        by.setdefault(len(values), []).append(values)
    return {width: _centres(_units(np.array(v).reshape(len(v), width))[0], count) for width, v in by.items()}


def _centres(units: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first picks, moved to the centres of what is nearest to them."""
    best = units @ units[0]
    picks = [0]
    while len(picks) < min(count, len(units)):
        picks.append(int(best.argmin()))
        best = np.maximum(best, units @ units[picks[-1]])
    found = units[picks]
    for _ in range(4):
        near = (units @ found.T).argmax(axis=1)
        found = np.array([_units(units[near == i].sum(axis=0)[None])[0][0] if (near == i).any() else f for i, f in enumerate(found)])
    return found


def _units(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms of the rows; a zero row has the direction zero and the norm 0."""
    most = np.abs(values).max(axis=1, initial=0.0)
    scaled = values / np.where(most > 0, most, 1)[:, None]
    norms = np.sqrt((scaled * scaled).sum(axis=1))
    return scaled / np.where(norms > 0, norms, 1)[:, None], np.minimum(norms * most, WILD**2)


def whole(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.floor(values * SCALE)


def _directions(refs: dict[int, np.ndarray], width: int) -> np.ndarray:
    """Widths that the sample lacks get fixed directions."""
    if width not in refs:
        refs[width] = _units(np.random.default_rng(width).standard_normal((REFERENCES, width)))[0]
    return refs[width]


def _angles(units: np.ndarray, directions: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ directions.T, -1, 1))


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and the matrix of their values, for each number of components."""
    column = batch.column("values")
    flat, offsets = column.flatten().to_numpy(), column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    widths = np.diff(offsets)
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        yield at, flat[offsets[:-1][at][:, None] + np.arange(w)[None, :]].reshape(len(at), w)


def _near(refs: dict[int, np.ndarray]):
    """Adds the number of components, the nearest reference and the angle to it: the order that blocks are cut in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width, near, angle = (np.zeros(batch.num_rows, t) for t in (np.int32, np.int32, np.float64))
            for at, values in _by_width(batch):
                found = _angles(_units(whole_or_large(values))[0], _directions(refs, values.shape[1]))
                width[at], near[at], angle[at] = values.shape[1], found.argmin(axis=1), found.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, (width, near, angle))],
                                             names=[*batch.schema.names, "width", "near", "angle"])

    return run


def whole_or_large(values: np.ndarray) -> np.ndarray:
    """Whole numbers, with those that pass a double's range at its end: their rows are wild in any case."""
    return np.nan_to_num(whole(values))


def _pack(refs: dict[int, np.ndarray], size: int):
    """Consecutive rows of one width, ``size`` at most, as one row with their norms and angles."""
    def one(parts: list[tuple]) -> pa.RecordBatch:
        numbers, ids, labels, values = (np.concatenate(c) for c in zip(*parts))
        units, norms = _units(whole_or_large(values))
        angles = _angles(units, _directions(refs, values.shape[1])).astype("<f4")
        exact = values.astype("<f4") if (values.astype("<f4") == values).all() else values.astype("<f8")
        kinds = [(values.shape[1], pa.int32()), (len(ids), pa.int32()), (int(labels.min()), pa.int64()), (int(labels.max()), pa.int64())]
        packed = (numbers.astype("<i8"), ids.astype("<i8"), labels.astype("<i8"), exact, norms.astype("<f8"), angles)
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in kinds] + [pa.array([p.tobytes()], pa.binary()) for p in packed],
            names=["width", "rows", "first", "last", "numbers", "ids", "labels", "values", "norms", "angles"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("number", "vec_id", "label")]
            for at, values in _by_width(batch):
                parts = held.setdefault(values.shape[1], [])
                parts.append((*[c[at] for c in columns], values))
                if sum(len(p[1]) for p in parts) >= size:
                    joined = [np.concatenate(c) for c in zip(*parts)]
                    full = len(joined[1]) // size * size
                    for a in range(0, full, size):
                        yield one([tuple(c[a:a + size] for c in joined)])
                    held[values.shape[1]] = [tuple(c[full:] for c in joined)]
        yield from (one(parts) for parts in held.values() if sum(len(p[1]) for p in parts))

    return run


def packed(rows: DataFrame, refs: dict[int, np.ndarray], size: int, purpose: str) -> DataFrame:
    """``rows`` in blocks of ``size``, sorted by label and place; the last block of a partition may be smaller."""
    placed = stored(rows.mapInArrow(_near(refs), f"{ROW}, width int, near int, angle double"), f"{purpose}-placed")
    order = ["width", "label", "near", "angle", "number"]
    dealt = placed.repartitionByRange(max(1, -(-placed.count() // (size * 8))), *order).sortWithinPartitions(*order)
    return stored(dealt.select("number", "vec_id", "label", "values").mapInArrow(_pack(refs, size), PACKED), purpose)


class Packed:
    """A block, or a batch of anchors, as arrays."""

    def __init__(self, row: dict, prefix: str = ""):
        get = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        n, width = row[prefix + "rows"], row["width"]
        raw = row[prefix + "values"]
        self.numbers, self.ids, self.labels = get("numbers", "<i8"), get("ids", "<i8"), get("labels", "<i8")
        self.raw = np.frombuffer(raw, "<f4" if len(raw) == 4 * n * width else "<f8").astype(np.float64).reshape(n, width)
        self.values, self.norms = whole(self.raw), get("norms", "<f8")
        self.angles = get("angles", "<f4").reshape(n, -1).T
        self.most = float(np.abs(self.values).max(initial=0.0))
        self.wild = np.abs(self.values).max(axis=1, initial=0.0) > WILD

    def exact(self, i: int) -> np.ndarray:
        """The whole components of row ``i`` as Python's integers."""
        return np.array([int(x) * SCALE if abs(x) > WILD else int(np.floor(x * SCALE)) for x in self.raw[i]], object)


def bounds(anchors: Packed, block: Packed) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of every (anchor, row); wild rows have no bounds.

    The angle is at least the greatest difference of two angles to a reference, and at most the least sum, or what a sum
    beyond pi leaves of the full circle. Differences and sums in 32 bits are within 5e-7 each.
    """
    shape, half = (len(anchors.ids), len(block.ids)), np.float32(np.pi)
    least, turned, step = (np.zeros(shape, "f4") for _ in range(3))  # turned: how far a sum is from pi
    for a, b in zip(anchors.angles, block.angles):
        np.subtract.outer(a, b, out=step)
        np.maximum(least, np.abs(step, out=step), out=least)
        np.add.outer(a - half, b, out=step)
        np.maximum(turned, np.abs(step, out=step), out=turned)
    scale = np.multiply.outer(anchors.norms, block.norms)
    low, high = scale * (-np.cos(turned.astype("f8")) - SLACK), scale * (np.cos(least.astype("f8")) + SLACK)
    wild = anchors.wild[:, None] | block.wild[None, :]
    low[wild], high[wild] = -np.inf, np.inf
    return low, high


def fits(anchors: Packed, block: Packed) -> bool:
    """Whether doubles hold all scores, and all sums on the way to them, exactly."""
    return block.values.shape[1] * max(anchors.most, 1.0) * max(block.most, 1.0) < 2.0**53


def scores(anchors: Packed, q: int, block: Packed, at: np.ndarray) -> np.ndarray:
    """Whole-number scores of anchor ``q`` with the rows ``at``: 64 bits where they fit, else Python's integers."""
    if fits(anchors, block):
        return (block.values[at] @ anchors.values[q]).astype(np.int64)
    own = anchors.exact(q)
    return np.array([int((block.exact(i) * own).sum()) if len(own) else 0 for i in at], object)


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _best(found: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -found))[:k] if found.dtype != object else np.array(
        sorted(range(len(ids)), key=lambda i: (-found[i], ids[i]))[:k], int)


def split(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """High and low part; beyond 64 bits of the high part, its limits."""
    if found.dtype == object:
        high = [min(max(int(v) >> SPLIT, -2**63), 2**63 - 1) for v in found]
        return np.array(high, np.int64), np.array([int(v) & (2**SPLIT - 1) for v in found], np.int64)
    return found >> SPLIT, found & (2**SPLIT - 1)


def positives_of(anchors: Packed, block: Packed, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Anchor, rows and scores: the ``k`` best rows of the block that bear an anchor's label."""
    low, high = bounds(anchors, block)
    for q in range(len(anchors.ids)):
        mine = np.flatnonzero((block.labels == anchors.labels[q]) & (block.ids != anchors.ids[q]))
        at = mine[high[q, mine] >= _kth(low[q, mine], k)]
        found = scores(anchors, q, block, at)
        best = _best(found, block.ids[at], k)
        if len(best):
            yield q, at[best], found[best]


def window(positive: int) -> tuple[int, int]:
    """The least and the greatest score of its negatives; below 0 there is none."""
    return -(-positive * LOW[0] // LOW[1]), positive * HIGH[0] // HIGH[1]


def _as_float(value: int) -> float:
    return float(min(max(value, -2**1000), 2**1000))


Found = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def negatives_of(anchors: Packed, asked: list[list[int]], block: Packed, k: int) -> Iterator[Found]:
    """Anchors, numbers of the positives, rows and scores: the block's ``k`` best rows of other labels in each window.

    ``asked`` has the positives' scores by anchor.
    """
    each = _together if fits(anchors, block) else _row_by_row
    yield from each(anchors, asked, block, k)


def _together(anchors: Packed, asked: list[list[int]], block: Packed, k: int) -> Iterator[Found]:
    """For scores that doubles hold: all anchors at once, one positive of each after the other."""
    low, high = bounds(anchors, block)
    number = max(map(len, asked), default=0)
    least, most = np.full((2, number, len(asked)), [[[np.inf]], [[-np.inf]]])
    for q, wanted in enumerate(asked):
        for j, (a, b) in enumerate(map(window, wanted)):
            if a <= b:
                least[j, q], most[j, q] = _as_float(a), _as_float(b)
    others = (block.labels != anchors.labels[:, None]) & (block.ids != anchors.ids[:, None])
    # No score is beyond 2^53, up to where the windows' ends are exact. Bounds are wider than they need be by SLACK.
    any_least, any_most = (f(axis=0, initial=i) for f, i in ((least.min, np.inf), (most.max, -np.inf)))
    others &= (high >= any_least[:, None]) & (low <= any_most[:, None])
    rows = np.flatnonzero(others.any(axis=0))
    if not len(rows):
        return
    rows = rows[np.argsort(block.ids[rows], kind="stable")]  # the first of equal scores has the smallest id
    found = np.where(others[:, rows], anchors.values @ block.values[rows].T, -np.inf)
    every = np.arange(len(asked))
    for j in range(number):
        inside = np.where((found >= least[j][:, None]) & (found <= most[j][:, None]), found, -np.inf)
        for _ in range(min(k, len(rows))):
            at = inside.argmax(axis=1)
            best = inside[every, at]
            good = np.flatnonzero(best > -np.inf)
            if not len(good):
                break
            yield good, np.full(len(good), j), rows[at[good]], best[good].astype(np.int64)
            inside[every, at] = -np.inf


def _row_by_row(anchors: Packed, asked: list[list[int]], block: Packed, k: int) -> Iterator[Found]:
    low, high = bounds(anchors, block)
    for q, wanted in enumerate(asked):
        others = (block.labels != anchors.labels[q]) & (block.ids != anchors.ids[q])
        if not others.any():
            continue
        for j, (least, most) in enumerate(map(window, wanted)):
            if least > most:
                continue
            # A little outwards: doubles near a large whole number are further apart than 1.
            a, b = (_as_float(v) * (1 + s * np.sign(v) * 1e-12) for v, s in ((least, -1), (most, 1)))
            sure = low[q][others & (low[q] >= a) & (high[q] <= b)]
            at = np.flatnonzero(others & (high[q] >= max(a, _kth(sure, k))) & (low[q] <= b))
            found = scores(anchors, q, block, at)
            inside = np.array([least <= v <= most for v in found], bool) if found.dtype == object else (found >= least) & (found <= most)
            at, found = at[inside], found[inside]
            best = _best(found, block.ids[at], k)
            if len(best):
                yield np.full(len(best), q), np.full(len(best), j), at[best], found[best]


def _meet(blocks: DataFrame, batches: DataFrame, condition: Column, extra: list[str]) -> DataFrame:
    """Every batch with every block of its width that the condition allows; blocks are dealt evenly."""
    groups = max(1, -(-blocks.count() // GROUP))
    left = blocks.withColumn("group", F.pmod(F.xxhash64("numbers", "ids"), F.lit(groups)))
    names = [f.split()[0] for f in PACKED.split(", ")[1:]]
    right = batches.select("width", *extra, *[F.col(c).alias(f"a_{c}") for c in names]).withColumn(
        "group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    return left.join(right, ["width", "group"]).where(condition).drop("group")


def _sides(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Packed, Packed]]:
    """Rows of a join with both sides unpacked; consecutive rows of one block unpack it once."""
    last, block = None, None
    for frame in frames:
        for i in range(frame.num_rows):
            row = frame.slice(i, 1).to_pylist()[0]
            if last != (row["width"], row["numbers"]):
                last, block = (row["width"], row["numbers"]), Packed(row)
            yield row, Packed(row, "a_"), block


def _hits(found: list[tuple]) -> pa.RecordBatch:
    kinds = [f.split() for f in HIT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int32() if t == "int" else pa.int64())
                                       for c, (_, t) in zip(zip(*found), kinds)], names=[n for n, _ in kinds])


def _full(n: int, *values: int) -> list[np.ndarray]:
    return [np.full(n, v, np.int64) for v in values]


def _find_positives(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, anchors, block in _sides(frames):
        found = [(*_full(len(at), anchors.numbers[q], anchors.ids[q], 0, 0, 0, 0), block.ids[at], *split(s))
                 for q, at, s in positives_of(anchors, block, POSITIVES)]
        if found:
            yield _hits(found)


def _find_negatives(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, anchors, block in _sides(frames):
        by = {p["number"]: p["positives"] for p in row["asked"]}
        mine = [by[n] for n in anchors.numbers]
        asked = [[(p["high"] << SPLIT) + p["low"] for p in ps] for ps in mine]
        # The positives of an anchor, filled up to as many as any has.
        table = np.zeros((3, len(mine), POSITIVES), np.int64)
        for q, ps in enumerate(mine):
            table[:, q, :len(ps)] = [[p[c] for p in ps] for c in ("vec_id", "high", "low")]
        found = [(anchors.numbers[q], anchors.ids[q], j, *table[:, q, j], block.ids[at], *split(s))
                 for q, j, at, s in negatives_of(anchors, asked, block, NEGATIVES)]
        if found:
            yield _hits(found)


def _first(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("high"), F.desc("low"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _long(high: str, low: str) -> Column:
    """The score, or the limit of a long that it passes."""
    high, low = F.col(high), F.col(low)
    near = F.least(F.greatest(high, F.lit(-2)), F.lit(1)).cast("bigint") * F.lit(2**SPLIT) + low
    return F.when(high > 1, F.lit(2**63 - 1)).when(high < -2, F.lit(-(2**63))).otherwise(near)


def mine(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` are all participants and ``anchors`` some of them (see :func:`participants`).
    """
    refs = references(rows)
    blocks = packed(rows, refs, BLOCK, "blocks")
    batches = packed(anchors, refs, BATCH, "anchors")
    same = (F.col("first") <= F.col("a_last")) & (F.col("a_first") <= F.col("last"))
    hits = _meet(blocks, batches, same, []).mapInArrow(_find_positives, HIT)
    chosen = _first(hits, ["number"], POSITIVES).groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "high", "low"))).alias("positives"))
    chosen = stored(chosen, "positives")
    held = stored(anchors.join(chosen.select("number"), "number", "left_semi"), "with-positives")
    batches = packed(held, refs, BATCH, "asking")
    # The numbers of a batch, to give it its anchors' positives: at most BATCH for each.
    numbers = batches.select("numbers").mapInArrow(_numbers, "numbers binary, number long")
    asked = (numbers.join(chosen, "number").groupBy("numbers")
             .agg(F.collect_list(F.struct("number", "positives")).alias("asked")))
    batches = stored(batches.join(asked, "numbers"), "asked")
    differ = ~((F.col("first") == F.col("last")) & (F.col("a_first") == F.col("a_last")) & (F.col("first") == F.col("a_first")))
    hits = _meet(blocks, batches, differ, ["asked"]).mapInArrow(_find_negatives, HIT)
    return _first(hits, ["number", "positive"], NEGATIVES).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        _long("p_high", "p_low").alias("positive_score"), _long("high", "low").alias("negative_score"))


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed_ in batch.column("numbers").to_pylist():
            own = np.frombuffer(packed_, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array([packed_] * len(own), pa.binary()), pa.array(own)], names=["numbers", "number"])


def hard_negatives(table: DataFrame, every: int = EVERY) -> DataFrame:
    """Negatives of every row whose ``vec_id`` is divisible by ``every``, against all rows."""
    rows = stored(participants(table), "participants")
    return mine(rows, rows.where(F.col("vec_id") % every == 0))
