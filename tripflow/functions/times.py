"""Time expressions for zone-less timestamps.

``date_trunc`` and ``timestampdiff`` turn a TIMESTAMP_NTZ into an instant of the session
time zone. Going through DATE, ``hour`` and ``minute`` keeps the wall-clock reading, so
results do not depend on the session zone and never hit a daylight-saving gap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.contracts import DAYPARTS, OTHER_DAYPART, RUSH_HOURS, WEEKEND_DAYS


def midnight(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    return F.timestamp_add("HOUR", F.hour(ts), midnight(ts))


def day_of_week(ts: Column) -> Column:
    """Sunday 0 to Saturday 6 (``dayofweek`` starts at 1)."""
    return F.dayofweek(ts) - F.lit(1)


def minute_steps(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end, negative when end is earlier.

    00:00:59 to 00:01:01 is 1 and 00:00:01 to 00:00:59 is 0, unlike elapsed minutes.
    """
    days = F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    return days * 1440 + (F.hour(end) - F.hour(start)) * 60 + (F.minute(end) - F.minute(start))


def is_weekend(ts: Column) -> Column:
    return day_of_week(ts).isin(WEEKEND_DAYS)


def is_rush_hour(hour: Column, bands: Sequence[tuple[int, int]] = RUSH_HOURS) -> Column:
    return reduce(lambda a, b: a | b, [hour.between(first, last) for first, last in bands])


def daypart(hour: Column, bands: Sequence[tuple[str, int, int]] = DAYPARTS) -> Column:
    labels = [F.when(hour.between(first, last), name) for name, first, last in bands]
    return F.coalesce(*labels, F.lit(OTHER_DAYPART))
