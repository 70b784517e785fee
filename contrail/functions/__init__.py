"""Column expressions.  Each returns a ``Column`` built from built-in functions."""

from contrail.functions.calendar import (calendar_columns, day_name, day_of_week_sun0,
                                         is_weekend, month_name)
from contrail.functions.cleaning import clean, equals_literal, null_if_above, typed_null
from contrail.functions.clock import (hhmm_to_minute, idiv, minute_to_hhmm, minute_to_hour,
                                      to_utc_wall)
from contrail.functions.keys import MISSING_TOKEN, surrogate_key
from contrail.functions.measures import (band, count_where, exact_avg, flag_gt, flag_lt, rate_pct,
                                         round_half_up, safe_ratio)

__all__ = [
    "band", "calendar_columns", "clean", "count_where", "day_name", "day_of_week_sun0",
    "equals_literal", "exact_avg", "flag_gt", "flag_lt", "hhmm_to_minute", "idiv", "is_weekend",
    "minute_to_hhmm", "minute_to_hour", "month_name", "MISSING_TOKEN", "null_if_above",
    "rate_pct", "round_half_up", "safe_ratio", "surrogate_key", "to_utc_wall", "typed_null",
]
