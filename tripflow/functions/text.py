from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.contracts import AIRPORT_BOROUGH, AIRPORT_WORD, BOROUGH_GROUPS, UNKNOWN_GROUP


def surrogate_key(*columns: str) -> Column:
    """MD5 hex of the columns' text joined by '-'.

    A NULL keeps its (empty) place: ``concat_ws`` would drop it together with its
    separator and let different keys collide.
    """
    parts: list[Column] = []
    for name in columns:
        parts += [F.lit("-"), F.coalesce(F.col(name).cast("string"), F.lit(""))]
    return F.md5(F.concat(*parts[1:]))


def borough_group(borough: Column) -> Column:
    groups = [F.when(borough == name, group) for name, group in BOROUGH_GROUPS.items()]
    return F.coalesce(*groups, F.lit(UNKNOWN_GROUP))


def is_airport(zone_name: Column, borough: Column) -> Column:
    named = zone_name.contains(AIRPORT_WORD) | (borough == AIRPORT_BOROUGH)
    return F.coalesce(named, F.lit(False))
