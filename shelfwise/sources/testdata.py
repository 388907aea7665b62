"""The test tables read as point-of-sale data (see FIXTURES.md).

Suppliers are the stores, parts fold into product families that act as SKUs,
and ship dates fold into one 30-day month so that cells repeat and leave gaps.
Every row of every table takes part.

The second reading, by part, keeps every part as a SKU of its own, spreads the rows over 90 days and
has faulty rows: unknown stores and SKUs, returns, missing quantities, missing and negative stock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The fold of keys and dates, and the simulated empty shelves.
SKU_FAMILIES = 50
MONTH_START = "2024-01-01"
FOLD_EPOCH = "1995-01-01"
MONTH_DAYS = 30
EMPTY_PERCENT = 12

# Fixed values of the reading by part: its days, and at which strides of order and line a row is faulty.
QUARTER_DAYS = 90
UNKNOWN_STORE, UNKNOWN_SKU = 41, 43
RETURNED, NO_QTY, NO_STOCK, NEGATIVE_STOCK = 37, 53, 31, 29

# What the readings take of a line item.
LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]

# Total order of the copies of one cell; rows that still tie are identical.
COPY_ORDER = ["order_id", "line_no", "qty_sold", "inventory_on_hand", "unit_price"]


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pos_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """POS columns plus the two order columns that rank copies; batch or streaming."""
    empty = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 100 < EMPTY_PERCENT
    shelf = 20 + (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17) % 100
    age = F.datediff(F.col("l_shipdate").cast("date"), F.lit(FOLD_EPOCH).cast("date"))
    return lineitem.select(
        F.col("l_suppkey").cast("bigint").alias("store_id"),
        (F.col("l_partkey") % SKU_FAMILIES).cast("bigint").alias("sku_id"),
        F.date_add(F.lit(MONTH_START).cast("date"), F.pmod(age, F.lit(MONTH_DAYS)))
        .alias("transaction_date"),
        F.when(empty, 0).otherwise(F.col("l_quantity").cast("int")).alias("qty_sold"),
        (F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).alias("unit_price"),
        F.when(empty, 0).otherwise(shelf.cast("int")).alias("inventory_on_hand"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
    )


def pos(spark: SparkSession, folder: str) -> DataFrame:
    return pos_from_lineitem(load(spark, folder, "lineitem"))


def pos_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The glob lets the source be a single file or a folder of files."""
    schema = load(spark, folder, "lineitem").schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return pos_from_lineitem(reader.parquet(f"{folder}/lineitem.parque[t]"))


def stores(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    return (
        load(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("bigint").alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("state"),
        )
    )


def skus(spark: SparkSession, folder: str) -> DataFrame:
    """One SKU per family: name and category of its first part, average list price of all."""
    price = F.sum(F.col("p_retailprice").cast("decimal(28,2)")).cast("double")
    return load(spark, folder, "part").groupBy(
        (F.col("p_partkey") % SKU_FAMILIES).cast("bigint").alias("sku_id")
    ).agg(
        F.min_by("p_name", "p_partkey").alias("sku_name"),
        F.min_by("p_type", "p_partkey").alias("category"),
        (price / F.count("p_retailprice")).alias("avg_unit_price"),
    )


def pos_by_part(spark: SparkSession, folder: str) -> DataFrame:
    """The second reading; which rows are faulty follows from order and line, so copies of a cell may differ in it."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    every = lambda stride, step: (order + line * step) % stride == 0
    shelf = (20 + (order * 31 + line * 17) % 100).cast("int")
    qty = F.col("l_quantity").cast("int")
    age = F.datediff(F.col("l_shipdate").cast("date"), F.lit(FOLD_EPOCH).cast("date"))
    store, sku = F.col("l_suppkey").cast("bigint"), F.col("l_partkey").cast("bigint")
    return load(spark, folder, "lineitem").select(
        F.when(order % UNKNOWN_STORE == 0, -1 - store).otherwise(store).alias("store_id"),
        F.when(order % UNKNOWN_SKU == 0, -1 - sku).otherwise(sku).alias("sku_id"),
        F.date_add(F.lit(MONTH_START).cast("date"), F.pmod(age, F.lit(QUARTER_DAYS))).alias("transaction_date"),
        F.when(every(RETURNED, 1), -qty).when(~every(NO_QTY, 3), qty).alias("qty_sold"),
        (F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).alias("unit_price"),
        F.when(every(NEGATIVE_STOCK, 5), -shelf).when(~every(NO_STOCK, 2), shelf).alias("inventory_on_hand"),
        order.alias("order_id"), line.alias("line_no"),
    )


def skus_by_part(spark: SparkSession, folder: str) -> DataFrame:
    """Every part is a SKU."""
    return load(spark, folder, "part").select(
        F.col("p_partkey").cast("bigint").alias("sku_id"), F.col("p_name").alias("sku_name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("avg_unit_price"))
