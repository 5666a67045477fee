"""From bronze rows to the star schema as one lazy plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tripflow.contracts import AUDIT, FACT
from tripflow.operators.fact import fact_trips, silver_inputs
from tripflow.operators.silver import silver_trips

FACT_VALUES = [name for name in FACT.names if name != AUDIT]


def fact_from_bronze(bronze: DataFrame, columns: Sequence[str] = FACT_VALUES) -> DataFrame:
    """Only the silver columns that the wanted fact columns need go through the shuffle."""
    return fact_trips(silver_trips(bronze, columns=silver_inputs(columns)), columns)
