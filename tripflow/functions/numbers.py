from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, and 0 when the denominator is zero, negative or NULL."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def to_integral(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast to an integer type; fractional input rounds half to even instead of truncating."""
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return F.rint(value).cast(target)
    if isinstance(source, T.DecimalType):
        return F.bround(value).cast(target)
    return value.cast(target)
