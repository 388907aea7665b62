"""Order MinHash fingerprints, and each document against its successor.

The k-mers of a text are numbered by occurrence, so repeats are told apart.
A hash of (k-mer, number) deals them to ``SLOTS`` slots; each slot selects its
``TUPLE`` minimal ones, puts them back in text order and hashes the tuple. Two texts
agree in a slot only if the same k-mers were selected and stand in the same order,
which follows edit distance more closely than the set alone does.
"""

from __future__ import annotations

import hashlib
import itertools
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.common import stored

K, SLOTS, TUPLE = 6, 128, 2
BUCKET = 64  # consecutive documents that one task handles together, about
BUCKETS = 16_384  # at most
DRAWN = 262_144   # ids, about, from which the buckets' bounds are found
LEAST = -2**63

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _A
    h = (h ^ (h >> np.uint64(27))) * _B
    return h ^ (h >> np.uint64(31))


def signature(codes: np.ndarray, k: int = K, slots: int = SLOTS, size: int = TUPLE) -> np.ndarray:
    """One 16-bit hash for each slot; 0 only where the text has no k-mer for the slot.

    ``codes`` are the code points of the whole text. A text shorter than k is one
    k-mer; an empty one fills no slot.
    """
    out = np.zeros(slots, np.uint16)
    n = len(codes)
    if not n:
        return out
    width = min(k, n)
    h = codes[: n - width + 1].astype(np.uint64) + np.uint64(width << 32)
    for j in range(1, width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[j: n - width + 1 + j]
    h = _mix(h)
    m = len(h)
    # Sorting (high bits of the hash, position) brings equal k-mers together in text order. The slots
    # take the whole hash: how many bits are high depends on the length.
    bits = np.uint64(max(1, int(m - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    packed = (h & ~low) | np.arange(m, dtype=np.uint64)
    packed.sort()
    place = packed & low
    kmer = h[place]
    new = np.concatenate(([True], kmer[1:] != kmer[:-1]))
    if (new[1:] & (packed[1:] | low == packed[:-1] | low)).any():  # two k-mers share the high bits
        place = np.argsort(h, kind="stable").astype(np.uint64)
        kmer = h[place]
        new = np.concatenate(([True], kmer[1:] != kmer[:-1]))
    starts = np.flatnonzero(new)
    number = np.arange(m) - np.repeat(starts, np.diff(np.append(starts, m)))
    value = _mix(kmer + number.astype(np.uint64) * _B)
    slot_bits = np.uint64(slots.bit_length() - 1)
    # Only small values can be among the least of a slot; all are looked at if too few are small.
    share = 12 * size * slots
    while True:
        if share < m:
            near = np.flatnonzero((value << slot_bits) < np.uint64(min(2**64 - 1, (share << 64) // m)))
        else:
            near = np.arange(m)
        key = value[near]
        slot = (key >> (np.uint64(64) - slot_bits)).astype(np.int64)
        counts = np.bincount(slot, minlength=slots)
        if share >= m or (counts >= size).all():
            break
        share *= 8
    order = np.argsort(key, kind="stable")
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    used = counts > 0
    picked = np.minimum(first[:, None] + np.arange(size)[None, :], (first + np.maximum(counts, 1) - 1)[:, None])
    chosen = near[order[np.minimum(picked, len(order) - 1)]]
    turn = np.argsort(place[chosen], axis=1, kind="stable")
    ordered = np.take_along_axis(value[chosen], turn, axis=1)
    total = np.zeros(slots, np.uint64)
    for j in range(size):
        total = _mix(total + ordered[:, j])
    hashed = (total >> np.uint64(48)).astype(np.uint16)
    out[used] = np.maximum(hashed[used], 1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of agreeing slots among those that either text fills; 1 for two empty texts."""
    filled = (a != 0) | (b != 0)
    n = int(filled.sum())
    return float(((a == b) & filled).sum() / n) if n else 1.0


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` (hex) of every row; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [code_points(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(c) for c in codes], pa.int64()),
                pa.array([signature(c).tobytes().hex() for c in codes], pa.string()),
            ], names=["doc_id", "n_chars", "fingerprint"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string")


def place(doc_id: int | None) -> tuple[bool, int]:
    """Sorts ids downwards, null last."""
    return doc_id is None, 0 if doc_id is None else -doc_id


def bucket_bounds(drawn: list[int | None], wanted: int) -> tuple[list[tuple[bool, int, int]], list[int | None]]:
    """Bounds ``(null, -id, hash)`` of ``wanted`` buckets with equal shares of the drawn ids, and the ids that take several.

    An id that occurs so often is cut by the hash of its texts, which is 0 for all other ids.
    """
    keys = sorted(map(place, drawn))
    cuts = [keys[len(keys) * j // wanted] for j in range(1, wanted)] if keys else []
    bounds, hot = [], []
    for key, same in itertools.groupby(cuts):
        pieces = len(list(same))
        bounds += [(*key, LEAST + j * 2**64 // pieces) for j in range(pieces)]
        if pieces > 1:
            hot.append(None if key[0] else -key[1])
    return bounds, hot


def _in_order(documents: DataFrame) -> DataFrame:
    """``bucket, guest, doc_id, part, packed``: documents by descending doc_id in buckets, null ids last.

    Bounds come from a sample of at most about ``DRAWN`` ids, so that buckets hold about equally many documents
    however ids are spread; the result does not depend on them. ``part`` is the texts' hash for ids that take several
    buckets. A bucket also gets, as a guest, the first document of the next one that has any; the last
    bucket gets the very first document.
    """
    ids = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n = ids.count()
    drawn = ids.select("doc_id") if n <= DRAWN else ids.select("doc_id").sample(DRAWN / n, 0)
    bounds, hot = bucket_bounds(drawn.toArrow().column("doc_id").to_pylist(), max(1, min(BUCKETS, n // BUCKET)))
    often = F.lit(False)
    if None in hot:
        often = F.col("doc_id").isNull()
    if known := [i for i in hot if i is not None]:
        often = often | F.coalesce(F.col("doc_id").isin(known), F.lit(False))
    part = F.when(often, F.xxhash64("text")).otherwise(F.lit(0).cast("bigint")) if hot else F.lit(0).cast("bigint")

    def bucket_of(batch: pa.RecordBatch) -> pa.Array:
        keys = zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist())
        return pa.array([bisect_right(bounds, (*place(i), h)) for i, h in keys], pa.int64())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packer = zstandard.ZstdCompressor(level=1)
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("part"),
                pa.array([packer.compress((t or "").encode("utf-8", "surrogatepass")) for t in texts], pa.binary()),
                bucket_of(batch),
            ], names=["doc_id", "part", "packed", "bucket"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), bucket_of(batch)], names=["doc_id", "part", "bucket"])

    dealt = ids.withColumn("part", part)
    rows = dealt.mapInArrow(pack, "doc_id bigint, part bigint, packed binary, bucket bigint")
    tops = dealt.select("doc_id", "part").mapInArrow(deal, "doc_id bigint, part bigint, bucket bigint")
    # The first of a bucket: the largest id, null after all others, and of it the least hash (its bits turned, the largest).
    first = F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", F.bitwise_not("part"))).alias("first")
    tops = stored(tops.groupBy("bucket").agg(first), "buckets")
    order = Window.orderBy("bucket")  # over one row a bucket
    hosts = tops.select(
        F.col("bucket").alias("_of"), F.col("first.doc_id").alias("_top"), F.bitwise_not(F.col("first.col3")).alias("_part"),
        F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.partitionBy())).alias("host"))
    # Of repeated rows with its id, the one that sorts first. At most BUCKETS rows are broadcast.
    firsts = (rows.join(F.broadcast(hosts), (F.col("bucket") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_top"))
                        & (F.col("part") == F.col("_part")))
              .groupBy("host", "doc_id", "part").agg(F.min("packed").alias("packed")))
    columns = ["doc_id", "part", "packed"]
    guests = firsts.select(F.col("host").alias("bucket"), F.lit(True).alias("guest"), *columns)
    return rows.select("bucket", F.lit(False).alias("guest"), *columns).unionByName(guests)


def against_next(documents: DataFrame) -> DataFrame:
    """Every document's fingerprint against those of its edited text and of its successor.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The successor is the next document by descending ``doc_id``, the first
    after the last; repeated ids follow each other in the order of their compressed texts (ids that fill several
    buckets: of their texts' hashes first), null ids come last. The edited text has its last ``n_chars // 2`` code points replaced by the
    first as many (or all) of the successor. Null texts are empty; a single document is its
    own successor; an empty table gives an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        held = None  # bucket, doc_id, text, codes, signature
        out: list[tuple] = []
        for batch in batches:
            for bucket, guest, doc_id, packed in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4))):
                text = reader.decompress(packed).decode("utf-8", "surrogatepass") if packed else ""
                codes = code_points(text)
                sign = signature(codes)
                if held is not None and held[0] == bucket:
                    out.append(_compare(held, text, sign))
                held = None if guest else (bucket, doc_id, text, codes, sign)
                if len(out) >= 500:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    ordered = _in_order(documents).repartition("bucket").sortWithinPartitions(
        "bucket", "guest", F.col("doc_id").desc_nulls_last(), "part", "packed")
    return ordered.mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")


def _compare(held: tuple, following: str, following_sign: np.ndarray) -> tuple:
    _, doc_id, text, codes, sign = held
    n = len(codes)
    edited = text[: n - n // 2] + following[: n // 2]
    edited_sign = signature(code_points(edited))
    return (doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            sign.tobytes().hex(), edited_sign.tobytes().hex(),
            likeness(sign, edited_sign), likeness(sign, following_sign))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
