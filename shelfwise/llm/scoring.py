"""Stupid-backoff scores of documents from n-gram counts of the whole corpus.

1. Texts are read in batches of bounded size. A batch keeps its distinct word hashes
   and, for every word, its place among them.
2. The batches' distinct unigrams and bigrams are exploded by hash part, as arrays of hashes with
   their numbers. A part of the count table and the n-grams that are joined to it are dealt by the
   same hash, so one task per part sums the numbers and gives every row its counts.
3. Each higher order takes a round of its own. An n-gram occurs no more often than the two that it is made of, so
   only those go out whose both parts occur ``LEAST`` times; the others back off whatever their number.
4. Each batch meets its counts, and its words' scores are summed per document.

With the orders up to ``ORDER``, an n-gram ``u w`` seen ``LEAST`` times or more scores ``c(u w) / c(u)``; any other
takes ``BACKOFF`` times the score of ``w`` after ``u`` without its first word. A word alone scores ``c(w) / N``, and a
document's first words have as much before them as there is. Every n-gram of a scored document is in
the counts once, by that document itself; so one seen once tells nothing, and ``LEAST`` is 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import LOWER, WordHashes, mix, small_batches, stored

BACKOFF, LEAST, ORDER = 0.4, 2, 2
GRAMS = 2_000_000  # n-grams of a part, before equal ones of a batch are put together

BATCH = "batch bigint, doc_ids array<bigint>, lengths array<bigint>, size int, vocabulary binary, places binary"
REQUEST = "part bigint, batch bigint, size int, grams binary, n binary"
REPLY = "part bigint, batch bigint, size int, counts binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 as eight planes of bytes, compressed: small ones take little."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, size * 8, "zstd", asbytes=True), np.uint8).reshape(8, size)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _steps(ranked: np.ndarray) -> np.ndarray:
    """The first of some sorted numbers, then what each adds to its predecessor."""
    return np.concatenate((ranked[:1], ranked[1:] - ranked[:-1]))


def word_batches(documents: DataFrame) -> DataFrame:
    """One row for each batch: its documents, their word counts and their words as places in the batch's vocabulary.

    The vocabulary's hashes stand by falling frequency, so frequent words have small places.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        first = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(small_batches(batches)):
            texts = [(t or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
                     for t in batch.column("text").to_pylist()]
            lengths = [len(t) for t in texts]
            words = np.fromiter((hashes[w] for t in texts for w in t), np.uint64, sum(lengths))
            vocabulary, places, often = np.unique(words, return_inverse=True, return_counts=True)
            order = np.argsort(-often, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            yield pa.RecordBatch.from_arrays([
                pa.array([first + i], pa.int64()),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([len(vocabulary)], pa.int32()),
                pa.array([_packed(vocabulary[order])], pa.binary()),
                pa.array([_packed(rank[places])], pa.binary()),
            ], names=["batch", "doc_ids", "lengths", "size", "vocabulary", "places"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, BATCH)


def rounds(order: int) -> list[tuple[int, ...]]:
    """The orders that each round counts."""
    return [(1, 2)[:order], *((k,) for k in range(3, order + 1))]


def _words(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a batch's words, how many stand before each in its document, and the documents' word counts."""
    lengths = np.array(row["lengths"], np.int64)
    words = _unpacked(row["vocabulary"], row["size"])[_unpacked(row["places"], int(lengths.sum()))]
    return words, np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths), lengths


def _asked(words: np.ndarray, before: np.ndarray, orders: tuple[int, ...], counts: dict[int, np.ndarray], least: int):
    """``[(order, positions)], hashes``: the n-grams that a round asks for, by the positions of their last words."""
    asked, hashes = [], []
    for k in orders:
        last = np.flatnonzero(before >= k - 1)
        if k > 2:
            last = last[(counts[k - 1][last] >= least) & (counts[k - 1][last - 1] >= least)]
        h = mix(words[last - (k - 1)] + np.uint64(k))
        for back in range(k - 2, -1, -1):
            h = mix(h ^ words[last - back])
        asked.append((k, last))
        hashes.append(h)
    return asked, np.concatenate(hashes)


def _counts(row: dict, replies: list[dict], plan: list[tuple[int, ...]], least: int):
    """Words, words before each, lengths, and for every order of ``plan`` the counts by the n-grams' last words (0: not asked)."""
    words, before, lengths = _words(row)
    counts: dict[int, np.ndarray] = {}
    for number, orders in enumerate(plan):
        asked, hashes = _asked(words, before, orders, counts, least)
        own = sorted((x for x in replies if x["round"] == number), key=lambda x: x["part"])
        found = [_unpacked(x["counts"], x["size"]) for x in own]
        found = np.concatenate(found or [np.empty(0, np.uint64)])[np.unique(hashes, return_inverse=True)[1]]
        for k, last in asked:
            counts[k] = np.zeros(len(words), np.uint64)
            counts[k][last], found = found[:len(last)], found[len(last):]
    return words, before, lengths, counts


def _request(batch: int, hashes: np.ndarray, parts: int) -> pa.RecordBatch:
    """Distinct n-grams of a batch with their numbers, a row for each part of the hash range that has any."""
    grams, n = np.unique(hashes, return_counts=True)
    # The order of parts is that of the hashes.
    part = ((grams >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    own, cuts = np.unique(part, return_index=True)
    ends = np.append(cuts[1:], len(grams))
    return pa.RecordBatch.from_arrays([
        pa.array(own.astype(np.int64)), pa.array(np.full(len(own), batch, np.int64)),
        pa.array((ends - cuts).astype(np.int32)),
        pa.array([_packed(_steps(grams[a:b])) for a, b in zip(cuts, ends)], pa.binary()),
        pa.array([_packed(n[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
    ], names=["part", "batch", "size", "grams", "n"])


def _first_requests(parts: int, orders: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, before, _ = _words(row)
                yield _request(row["batch"], _asked(words, before, orders, {}, 0)[1], parts)
    return run


def _next_requests(parts: int, plan: list[tuple[int, ...]], orders: tuple[int, ...], least: int):
    """What a batch asks for after the rounds of ``plan``."""
    def run(batches: pa.Table, replies: pa.Table) -> pa.Table:
        row = batches.to_pylist()[0]
        words, before, _, counts = _counts(row, replies.to_pylist(), plan, least)
        return pa.Table.from_batches([_request(row["batch"], _asked(words, before, orders, counts, least)[1], parts)])
    return run


def _counted(part: pa.Table) -> pa.Table:
    """Every n-gram of a part's rows with its count in the corpus."""
    sizes = part.column("size").to_pylist()
    grams = np.concatenate([np.cumsum(_unpacked(x, k), dtype=np.uint64) for x, k in zip(part.column("grams").to_pylist(), sizes)])
    n = np.concatenate([_unpacked(x, k) for x, k in zip(part.column("n").to_pylist(), sizes)])
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    counts = np.empty(len(grams), np.uint64)
    counts[order] = np.repeat(np.add.reduceat(n[order], first), np.diff(np.append(first, len(grams))))
    packed = [_packed(c) for c in np.split(counts, np.cumsum(sizes)[:-1])]
    return part.select(["part", "batch", "size"]).append_column("counts", pa.array(packed, pa.binary()))


def _scored(total: int, backoff: float, least: int, plan: list[tuple[int, ...]]):
    """Documents of a batch with their scores, from the batch and its counts."""
    def run(batches: pa.Table, replies: pa.Table) -> pa.Table:
        row = batches.to_pylist()[0]
        words, before, lengths, counts = _counts(row, replies.to_pylist(), plan, least)
        score = np.log(counts[1] / total) if len(words) else np.empty(0)
        for k in range(2, plan[-1][-1] + 1):
            last = np.flatnonzero(before >= k - 1)
            seen = counts[k][last] >= least
            score[last[~seen]] += np.log(backoff)
            last = last[seen]
            score[last] = np.log(counts[k][last] / counts[k - 1][last - 1])
        sums = np.bincount(np.repeat(np.arange(len(lengths)), lengths), score, len(lengths))
        return pa.Table.from_arrays([
            pa.array(row["doc_ids"], pa.int64()), pa.array(lengths),
            pa.array(sums / np.maximum(lengths, 1), mask=lengths == 0),
        ], names=["doc_id", "n_words", "log_score"])
    return run


def scores(documents: DataFrame, backoff: float = BACKOFF, least: int = LEAST, order: int = ORDER) -> DataFrame:
    """``doc_id, n_words, log_score`` (natural logarithm, mean per word) of every row of ``documents``.

    Words are runs of anything but ASCII blanks, A-Z in lower case. Null and blank texts have 0 words and
    a null score. Repeated rows count as often as they occur and get equal scores. An
    empty table gives an empty one. A batch holds about 4 MB of text or one longer text; a part of the
    count table about ``GRAMS`` n-grams, however large the corpus. ``order`` is the longest n-gram's number of
    words, 1 or more; ``least`` is 1 or more.
    """
    if order < 1 or least < 1:
        raise ValueError("order and least start at 1")
    batches = stored(word_batches(documents), "words")
    total = batches.select(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    parts = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * total // GRAMS))
    plan, replies = rounds(order), None
    for number, orders in enumerate(plan):
        if replies is None:
            asked = batches.mapInArrow(_first_requests(parts, orders), REQUEST)
        else:
            replies = stored(replies, "counts")
            asked = (batches.groupBy("batch").cogroup(replies.groupBy("batch"))
                     .applyInArrow(_next_requests(parts, plan[:number], orders, least), REQUEST))
        reply = asked.groupBy("part").applyInArrow(_counted, REPLY).withColumn("round", F.lit(number))
        replies = reply if replies is None else replies.unionByName(reply)
    return (batches.groupBy("batch").cogroup(replies.groupBy("batch"))
            .applyInArrow(_scored(total, backoff, least, plan), "doc_id bigint, n_words bigint, log_score double"))
