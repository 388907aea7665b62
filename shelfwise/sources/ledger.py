"""Which files of a landing folder are new, changed or gone, and which dates that touches."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.schemas import POS

FILE = ["path", "modified", "size"]
LEDGER = "path string, modified timestamp, size long, dates array<date>"


def landed(spark: SparkSession, folder: str) -> DataFrame:
    """``path, modified, size`` of the data files below a folder; no content is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "[!_.]*").load(folder))
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def entries(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame:
    """The ledger of a folder: each file with its dates. Files that ``known``, an earlier ledger, has are not read."""
    files = landed(spark, folder)
    if known is None:
        known = spark.createDataFrame([], LEDGER)
    fresh = files.join(known, FILE, "left_anti")
    paths = [row["path"] for row in fresh.select("path").collect()]  # names, of new files only
    kept = known.join(files, FILE, "left_semi").select(*FILE, "dates")
    if not paths:
        return kept
    place = F.col("_metadata.file_path").alias("path")
    dates = (spark.read.schema(POS).option("basePath", folder).parquet(*paths).select(place, "transaction_date").groupBy("path")
             .agg(F.sort_array(F.collect_set("transaction_date")).alias("dates")))
    none = F.array().cast("array<date>")
    return kept.unionByName(fresh.join(dates, "path", "left").select(*FILE, F.coalesce("dates", none).alias("dates")))


def first_touched(before: DataFrame, after: DataFrame) -> datetime.date | None:
    """The first date of a file that only one of two ledgers has: new, changed and removed files alike."""
    either = [a.join(b, FILE, "left_anti") for a, b in ((before, after), (after, before))]
    return either[0].unionByName(either[1]).agg(F.min(F.array_min("dates"))).first()[0]
