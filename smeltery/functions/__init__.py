from .dates import date_key, epoch_seconds, minutes_between
from .money import half_up_quotient, is_exact, units
from .predicates import all_hold, any_null, negative, rule_columns

__all__ = [
    "all_hold",
    "any_null",
    "date_key",
    "epoch_seconds",
    "half_up_quotient",
    "is_exact",
    "minutes_between",
    "negative",
    "rule_columns",
    "units",
]
