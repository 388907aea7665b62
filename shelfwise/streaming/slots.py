"""Folders that hold the rows of the newest batches.

Batch K replaces what slot ``K % slots`` holds, so there are never more folders than slots, a replayed
batch rewrites its own, and nothing needs to be deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_slot(rows: DataFrame, folder: str, batch_id: int, slots: int) -> None:
    """The batch's number is a partition below its slot; an empty batch leaves an empty slot."""
    rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").partitionBy("batch_id").parquet(
        f"{folder}/slot={batch_id % slots}")


def read_slots(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """The rows of the batches from ``first`` to ``last``; only their folders are read."""
    return spark.read.parquet(folder).where(F.col("batch_id").between(first, last)).drop("slot", "batch_id")


def last_batch(spark: SparkSession, folder: str) -> int:
    """The last batch with rows, from the folders' names, which appear when a write is committed."""
    return spark.read.parquet(folder).agg(F.max("batch_id")).first()[0]
