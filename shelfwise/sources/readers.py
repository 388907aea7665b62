"""Batch and streaming readers with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from shelfwise.schemas import POS


def read_pos(spark: SparkSession, path: str, schema: T.StructType = POS) -> DataFrame:
    """The landing folder. A declared schema saves the footer-inference pass."""
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(name)
    return df.select(*columns) if columns else df


def stream_pos(
    spark: SparkSession, path: str, schema: T.StructType = POS, max_files: int | None = None
) -> DataFrame:
    """The landing folder as an unbounded source; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def pos_from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType = POS) -> DataFrame:
    """Local rows with a declared schema, for small dimensions and tests."""
    return spark.createDataFrame(list(rows), schema)
