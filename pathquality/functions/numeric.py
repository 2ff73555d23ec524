from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, digits: int = 0) -> Column:
    """Round half to even at a decimal position, staying in double arithmetic."""
    if digits == 0:
        return F.rint(value)
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division in double, NULL when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(F.lit(100.0) * numerator.cast("double"), denominator.cast("double"))


def sum_if(value: Column, condition: Column) -> Column:
    """Conditional sum that is 0, not NULL, when nothing qualifies."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))
