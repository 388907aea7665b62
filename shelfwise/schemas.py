"""Declared table schemas and the constants the signals are defined by."""

from pyspark.sql import types as T

POS = T.StructType([
    T.StructField("store_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
    T.StructField("transaction_date", T.DateType()),
    T.StructField("qty_sold", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("inventory_on_hand", T.IntegerType()),
])

STORES = T.StructType([
    T.StructField("store_id", T.LongType()),
    T.StructField("store_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("state", T.StringType()),
])

SKUS = T.StructType([
    T.StructField("sku_id", T.LongType()),
    T.StructField("sku_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("avg_unit_price", T.DoubleType()),
])

PAIR_KEYS = T.StructType([
    T.StructField("store_id", T.LongType()),
    T.StructField("sku_id", T.LongType()),
])

PAIR = ["store_id", "sku_id"]
CELL = PAIR + ["transaction_date"]

# Table names of the three layers.
BRONZE = "pos_transactions_raw"
SILVER = "pos_store_sku_signals"
GOLD = "replenishment_signals"

# Status labels, day thresholds and frame lengths (in rows).
REORDER_NOW = "REORDER NOW"
WATCH = "WATCH"
OK = "OK"
STATUSES = [REORDER_NOW, WATCH, OK]
REORDER_DAYS = 3
WATCH_DAYS = 7
SHORT_FRAME = 7
LONG_FRAME = 14
