"""Reporting months: bounds and the month a run is about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.contracts import FIRST_YEAR, LAG_MONTHS


def check_period(year: int, month: int, first_year: int = FIRST_YEAR) -> None:
    if not 1 <= month <= 12:
        raise ValueError(f"month must be 1 to 12, got {month}")
    if year < first_year:
        raise ValueError(f"data starts in {first_year}, got year {year}")


def target_month(run_date: Column, lag: int = LAG_MONTHS) -> Column:
    """First day of the month that a run on ``run_date`` has to load."""
    return F.add_months(F.trunc(run_date.cast("date"), "month"), -lag)


def valid_period(year: Column, month: Column, first_year: int = FIRST_YEAR) -> Column:
    return month.between(1, 12) & (year >= first_year)


def target_periods(
    runs: DataFrame, run_date: str, lag: int = LAG_MONTHS, first_year: int = FIRST_YEAR
) -> DataFrame:
    """The valid target periods of a table of runs, with the number of runs for each."""
    target = target_month(F.col(run_date), lag)
    return (
        runs.filter(F.col(run_date).isNotNull())
        .select(F.year(target).alias("year"), F.month(target).alias("month"))
        .filter(valid_period(F.col("year"), F.col("month"), first_year))
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("runs"))
    )
