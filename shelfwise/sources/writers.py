"""Table and folder sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def create_database(spark: SparkSession, name: str, folder: str | None = None) -> None:
    """With ``folder`` its managed tables lie there instead of in the warehouse."""
    place = f" LOCATION '{folder}'" if folder else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def _comment(spark: SparkSession, table: str, comment: str | None) -> None:
    if comment:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")


def save_table(df: DataFrame, table: str, comment: str | None = None, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").saveAsTable(table)
    _comment(df.sparkSession, table, comment)


def save_by_date(df: DataFrame, table: str, column: str = "transaction_date", comment: str | None = None, fmt: str = "parquet") -> None:
    """Date-partitioned table, replaced as a whole.

    The rebalance gathers each date in as few files as its size allows and lets
    AQE split a date that is too large for one task. Without it every task would
    open a file per date.
    """
    df.hint("rebalance", column).write.format(fmt).mode("overwrite").partitionBy(column).saveAsTable(table)
    _comment(df.sparkSession, table, comment)


def write_dates(df: DataFrame, path: str, column: str = "transaction_date", fmt: str = "parquet") -> None:
    """Date folders below ``path``; those of the dates in ``df`` are replaced when all is written, others stay.

    The mode belongs to this writer, so other jobs of the session keep theirs.
    """
    (df.hint("rebalance", column).write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(column).save(path))


def register_folder(
    spark: SparkSession, table: str, path: str, comment: str | None = None, fmt: str = "parquet"
) -> None:
    """Catalog entry over files that stay where they landed: nothing is copied."""
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "MANAGED":
            raise ValueError(f"{table} is a managed table; dropping it would delete its rows")
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source=fmt)
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    _comment(spark, table, comment)
