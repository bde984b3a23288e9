from .compare import any_changed, changed
from .dates import FIRST_DAY, LAST_DAY, date_attributes, date_key, days_between
from .keys import dense_key, fact_key, grown_keys, surrogate_key
from .measures import discount_band, late_flag, mean, net_amount, percent, ship_mode
from .money import divide_half_up, to_decimal, units

__all__ = [
    "FIRST_DAY", "LAST_DAY", "any_changed", "changed", "date_attributes", "date_key",
    "days_between", "dense_key", "discount_band", "divide_half_up", "fact_key", "grown_keys", "late_flag",
    "mean", "net_amount", "percent", "ship_mode", "surrogate_key", "to_decimal", "units",
]
