"""What several operators share: tables, stored intermediates, bounded batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.session import run_folder

# Words are runs of anything but space and the five ASCII control blanks.
BLANKS = r"[\x20\x09-\x0D]+"
BATCH_BYTES = 4_000_000
VOCABULARY = 500_000  # word hashes that a worker remembers
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z to a-z
_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """Hash of a word, remembered for at most ``VOCABULARY`` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= VOCABULARY:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _C1
    return (h ^ (h >> np.uint64(27))) * _C2


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage ends here.

    Later reads see the same rows however often a task is repeated, and Spark
    knows the measured size, on which it decides whether a join may broadcast.
    """
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = [len(x) if x is not None else 0 for x in _views(batch.column(column))]
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if i > start and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def _views(array: pa.Array):
    """Only lengths are needed; they come from the offsets, not from copies of the texts."""
    import pyarrow.compute as pc

    lengths = pc.binary_length(array).to_pylist()
    return [None if n is None else range(n) for n in lengths]


def word_count(text: Column) -> Column:
    """Words of a whole text; 0 for a null."""
    gaps = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(gaps, F.lit(0)).cast("bigint")
