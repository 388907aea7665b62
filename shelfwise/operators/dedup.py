"""Keyed duplicate elimination with a reproducible survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.schemas import CELL


def dedup(
    pos: DataFrame,
    keys: Sequence[str] = CELL,
    order_by: Sequence | None = None,
    hash_first: bool = True,
) -> DataFrame:
    """Keep the first row of every key.

    ``order_by`` should be a total order; by default it is every other column in
    schema order, so rows that still tie are identical. The ``row_number() = 1``
    filter makes Catalyst place a group limit *before* the shuffle: each map task
    sends at most one row per key, so a key with a third of all rows costs its
    reducer one row per map task.

    A leading key hash lets the two sorts decide nearly every comparison on one
    number instead of whole rows. Without it the output is sorted by the keys, for
    a following window to reuse.
    """
    order = list(order_by) if order_by else [c for c in pos.columns if c not in set(keys)]
    groups = [F.xxhash64(*keys), *keys] if hash_first else keys
    first = Window.partitionBy(*groups).orderBy(*order)
    return pos.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
