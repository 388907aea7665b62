from shelfwise.functions.calendar import day_of_week, dow_factor
from shelfwise.functions.labels import padded_id, round_robin, urgency_band
from shelfwise.functions.measures import at_risk_value, exact_mean, exact_sum, percent
from shelfwise.functions.supply import days_of_supply, status

__all__ = [
    "at_risk_value", "day_of_week", "days_of_supply", "dow_factor", "exact_mean",
    "exact_sum", "padded_id", "percent", "round_robin", "status", "urgency_band",
]
