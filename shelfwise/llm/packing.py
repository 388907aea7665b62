"""Best-fit packing of tokenised documents by large-item matching.

A plan needs the piece lengths only, and there are at most ``capacity`` of
them. So the counts by length, a table of bounded size whatever the corpus, are planned
as a whole, and the plan, again of bounded size, says which sequences the i-th piece
of a length goes to. Numbering the pieces of a length is the only
step that moves rows; it runs in salted groups, as one length may hold a third of all.

The plan: pieces above a third of the capacity fit a sequence at most twice;
from the largest down, each is matched with the largest such piece that still fits beside it.
Then the smaller pieces, from the largest down, go where the
smallest sufficient gap is left, and open sequences of their own when none is.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfwise.llm.common import small_batches, stored

CAPACITY, END = 2048, 0
VOCABULARY = "byte_bpe_50k"
SALT_ROWS = 50_000  # pieces of a length that are numbered together, about, if one length holds them all


def encoder(vocabulary: str = VOCABULARY):
    """Text to ids. tiktoken runs the tokenizer's ranks; ``tests/llm`` holds its ids against tokenizers'.

    A text whose blanks or letters run on too long for its regular expression goes to
    tokenizers itself.
    """
    import base64

    import public_tokenizers
    import tiktoken

    known = tiktoken.registry.ENCODINGS  # lives as long as the worker
    name = f"plain-{vocabulary}"
    if name not in known:
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        known[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    fast, exact = known[name], []

    def encode(text: str) -> list[int]:
        if len(text) < 500_000:
            return fast.encode_ordinary(text)
        if not exact:
            from tokenizers import Tokenizer
            exact.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
            exact[0].encode_special_tokens = True
        return exact[0].encode(text, add_special_tokens=False).ids

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of n ids; only the first of several may be short."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def pieces(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``, of every document.

    A null text counts as empty. Id 0 ends every document, so each has a piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in small_batches(batches):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), END], "<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start: start + length]
                    out.append((doc_id, piece, start, length, zlib.crc32(part.tobytes()), part if with_ids else None))
            columns = list(zip(*out))
            arrays = [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in columns[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return rows.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """``(length, from, to, sequence, offset)``: pieces ``from .. to - 1`` of a length go, one each,
    to the sequences from ``sequence`` on, at ``offset``.

    ``counts`` has the number of pieces by length. Works on runs of equal sequences,
    so its time depends on the number of lengths, not of pieces.
    """
    left = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[list[int]]] = {}  # gap: runs of [first sequence, number]
    sizes: list[int] = []                  # the gaps there are, ascending
    opened = 0

    def put(length: int, n: int, sequence: int, offset: int) -> None:
        out.append((length, used[length], used[length] + n, sequence, offset))
        used[length] += n
        left[length] -= n

    def keep(gap: int, sequence: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append([sequence, n])

    large = sorted(x for x in left if x * 3 > capacity)
    for length in reversed(large):
        while left[length]:
            at = bisect.bisect_right(large, min(length, capacity - length)) - 1
            while at >= 0 and left[large[at]] - (large[at] == length) <= 0:
                at -= 1
            n, other = left[length], None
            if at >= 0:
                other = large[at]
                n = n // 2 if other == length else min(n, left[other])
            put(length, n, opened, 0)
            if other is not None:
                put(other, n, opened, length)
            keep(capacity - length - (other or 0), opened, n)
            opened += n
    for length in sorted((x for x in left if x * 3 <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                fit = capacity // length
                n = -(-left[length] // fit)
                keep(capacity, opened, n)
                opened += n
                continue
            gap = sizes[at]
            run = gaps[gap][-1]
            n = min(run[1], left[length])
            put(length, n, run[0], capacity - gap)
            keep(gap - length, run[0], n)
            run[0], run[1] = run[0] + n, run[1] - n
            if not run[1]:
                gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.remove(gap)
    return out


def pack(spark: SparkSession, rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of :func:`pieces`.

    Pieces of equal length are interchangeable, so ties and repeated rows need no rule:
    they are numbered by id, piece and content. An empty table gives an empty one.
    """
    salts = max(8, rows.count() // SALT_ROWS)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("_base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "counts")
    # At most ``capacity`` rows.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(
        plan(totals, capacity), "_length bigint, _from bigint, _to bigint, _sequence bigint, offset bigint")
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (salted.withColumn("_nth", F.row_number().over(order) - 1)
                .join(counts.drop("n"), ["length", "_salt"])
                .withColumn("_i", F.col("_base") + F.col("_nth")))
    # The plan has some thousand rows at any corpus size.
    met = (F.col("length") == F.col("_length")) & (F.col("_i") >= F.col("_from")) & (F.col("_i") < F.col("_to"))
    placed = numbered.join(F.broadcast(runs), met)
    return placed.select(*rows.columns, (F.col("_sequence") + F.col("_i") - F.col("_from")).alias("sequence_id"), "offset")


def packed(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Where every piece of every document goes."""
    return pack(documents.sparkSession, stored(pieces(documents, capacity, vocabulary), "pieces"), capacity)


def sequences(documents: DataFrame, placed: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """``sequence_id, ids``: the packed sequences, of ``capacity`` ids at most each."""
    keys = ["doc_id", "piece", "ids_crc32"]
    ids = pieces(documents, capacity, vocabulary, with_ids=True).select(*keys, "ids").dropDuplicates(keys)
    return (placed.join(ids, keys).groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids")))
