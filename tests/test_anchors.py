"""Counts that the survey probed, under the survey's own mapping (FIXTURES.md, section 3a)."""

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import gold, kpis, signal_history, silver
from shelfwise.sources import testdata as td

# scale: (silver rows, gold rows, reorder, watch, ok, silver rows without demand)
ANCHORS = {
    "0.001": (4938, 175, 99, 70, 6, 81),
    "0.01": (25989, 867, 473, 352, 42, 144),
    "0.1": (30000, 1000, 556, 411, 33, 128),
}


@pytest.mark.parametrize("scale", sorted(ANCHORS))
def test_probed_counts(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    pos = td.pos(spark, folder).withColumn("store_id", F.col("store_id") % 20)
    rows = silver(pos, td.COPY_ORDER).persist()
    signals = gold(rows).persist()
    status = {r[0]: r[1] for r in kpis.status_distribution(signals).collect()}
    idle = signal_history(rows).where("days_of_supply IS NULL").count()
    assert ANCHORS[scale] == (
        rows.count(), signals.count(), status["REORDER NOW"], status["WATCH"], status["OK"], idle)
    if scale == "0.01":
        skus = td.load(spark, folder, "part").where("p_partkey < 50").select(
            F.col("p_partkey").alias("sku_id"), F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("avg_unit_price"))
        assert kpis.revenue_at_risk(signals, skus).first()[0] == 71059198
        at_risk = {r.category: r.stores_at_risk for r in kpis.category_risk(signals, skus).collect()}
        assert at_risk == {"ECONOMY": 84, "LARGE": 88, "MEDIUM": 102, "PROMO": 67,
                           "SMALL": 71, "STANDARD": 61}
    rows.unpersist()
    signals.unpersist()
