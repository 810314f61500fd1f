"""Column functions; all compile to JVM expressions inside whole-stage codegen."""

from cardlens.functions.geo import euclid_deg, haversine_km
from cardlens.functions.numeric import cents, money_mean, money_sum, percent, round_half_up
from cardlens.functions.temporal import age_exact, age_years, clock_time, parse_date, parse_time, trans_day, trans_hour
from cardlens.functions.text import amount_text, category_label, mask_card, or_default, status_label, truncate

__all__ = [
    "age_exact", "age_years", "amount_text", "category_label", "cents", "clock_time", "euclid_deg",
    "haversine_km", "mask_card", "money_mean", "money_sum", "or_default", "parse_date",
    "parse_time", "percent", "round_half_up", "status_label", "trans_day", "trans_hour",
    "truncate",
]
