from tripflow.functions.numbers import ratio_or_zero, to_integral
from tripflow.functions.text import borough_group, is_airport, surrogate_key
from tripflow.functions.times import (
    day_of_week,
    daypart,
    hour_start,
    is_rush_hour,
    is_weekend,
    midnight,
    minute_steps,
    month_start,
)

__all__ = [
    "borough_group",
    "day_of_week",
    "daypart",
    "hour_start",
    "is_airport",
    "is_rush_hour",
    "is_weekend",
    "midnight",
    "minute_steps",
    "month_start",
    "ratio_or_zero",
    "surrogate_key",
    "to_integral",
]
