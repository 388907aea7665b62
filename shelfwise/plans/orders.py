"""Purchase-order lines for reorder rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions import urgency_band
from shelfwise.functions.labels import DESK_BANDS, WEB_BANDS
from shelfwise.operators import with_dimensions
from shelfwise.plans.kpis import reorder_rows
from shelfwise.schemas import PAIR, REORDER_NOW
from shelfwise.sources import write_dates

# The order message. %s take the columns listed beside the text.
SUBJECT = "Replenish SKU %s at store %s"
SUBJECT_FIELDS = ["sku_id", "store_id"]
BODY = "\n".join([
    "Please deliver to store %s (%s) more of SKU %s (%s).",
    "On hand: %s; lasts %s days at %s sold a day.",
])
BODY_FIELDS = [
    "store_id", "region", "sku_id", "category",
    "inventory_on_hand", "days_of_supply", "avg_daily_demand_7d",
]

ORDER_KEY = ["signal_date", "store_id", "sku_id"]


def _text(template: str, fields: list[str]) -> Column:
    return F.format_string(template, *[F.col(name).cast("string") for name in fields])


def purchase_order_lines(
    gold: DataFrame, stores: DataFrame, skus: DataFrame, pairs: DataFrame | None = None
) -> DataFrame:
    """One order line per reorder row; ``ORDER_KEY`` identifies it, so re-runs can be recognised.

    Labels of pairs missing from a dimension are empty text; the order still goes out. ``pairs``
    (store_id, sku_id) orders for those pairs alone, whatever their status.
    """
    wanted = reorder_rows(gold) if pairs is None else gold.join(pairs.select(*PAIR), PAIR, "left_semi")
    labelled = with_dimensions(wanted, stores, skus, "left").na.fill(
        "", ["region", "category"])
    return labelled.select(
        *ORDER_KEY, "region", "category",
        "inventory_on_hand", "days_of_supply", "avg_daily_demand_7d",
        F.concat_ws("|", "signal_date", "store_id", "sku_id").alias("order_key"),
        _text(SUBJECT, SUBJECT_FIELDS).alias("subject"),
        _text(BODY, BODY_FIELDS).alias("body"),
    )


def write_orders(lines: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One folder per signal date, replaced as a whole: running a date again adds no order."""
    write_dates(lines, path, "signal_date", fmt)


def urgency_bands(gold: DataFrame) -> DataFrame:
    """Reorder rows with the two display bands."""
    days = F.col("days_of_supply")
    return gold.where(F.col("replenishment_status") == REORDER_NOW).select(
        "store_id", "sku_id", "days_of_supply",
        urgency_band(days, *WEB_BANDS).alias("urgency_band"),
        urgency_band(days, *DESK_BANDS).alias("desk_band"),
    )
