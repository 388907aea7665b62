"""N:1 joins to the store and SKU dimensions.

No broadcast hint: Spark broadcasts a dimension when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, with AQE
splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def with_skus(df: DataFrame, skus: DataFrame, how: str = "inner") -> DataFrame:
    return df.join(skus, "sku_id", how)


def with_stores(df: DataFrame, stores: DataFrame, how: str = "inner") -> DataFrame:
    return df.join(stores, "store_id", how)


def with_dimensions(df: DataFrame, stores: DataFrame, skus: DataFrame, how: str = "inner") -> DataFrame:
    return with_skus(with_stores(df, stores, how), skus, how)
