from shelfwise.operators.dedup import dedup
from shelfwise.operators.latest import latest_date, on_latest_date, on_latest_per_pair
from shelfwise.operators.lookup import with_dimensions, with_skus, with_stores
from shelfwise.operators.panel import (
    date_spine, dense_daily, first_sales, panel_since, panel_spine, whole_panel,
)
from shelfwise.operators.quality import DEFAULT_RULES, observe_rules, rule_report
from shelfwise.operators.rolling import rolling_mean
from shelfwise.operators.topk import top_k

__all__ = [
    "DEFAULT_RULES", "date_spine", "dedup", "dense_daily", "first_sales", "latest_date",
    "observe_rules", "on_latest_date", "on_latest_per_pair", "panel_since", "panel_spine",
    "rolling_mean", "rule_report", "top_k", "whole_panel", "with_dimensions", "with_skus", "with_stores",
]
