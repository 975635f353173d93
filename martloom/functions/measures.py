"""Ratios with the two divide guards in use, and averages that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# A double is averaged in whole units of this size: a sum of whole numbers is the same whatever order its parts
# arrive in. Averages from 1e-12 up to 1e12 keep their digits over as many rows.
UNITS_PER_ONE = 1e12
UNITS = "decimal(38,0)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_or_zero(numerator: str | Column, denominator: str | Column, scale: float | None = None) -> Column:
    """numerator / denominator (times scale), 0 unless the denominator is above 0."""
    top, bottom = _col(numerator), _col(denominator)
    quotient = top.cast("double") / bottom.cast("double")
    if scale is not None:
        quotient = quotient * F.lit(float(scale))
    return F.when(bottom > 0, quotient).otherwise(F.lit(0.0))


def ratio_or_null(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator, NULL when the denominator is 0."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def mean(c: str | Column) -> Column:
    """Aggregate: average of an exact column (integer or decimal) as a double."""
    return F.try_divide(F.sum(_col(c)).cast("double"), F.count(_col(c)).cast("double"))


def ratio_units(c: str | Column) -> Column:
    return (_col(c).cast("double") * F.lit(UNITS_PER_ONE)).cast(UNITS)


def mean_of_units(total: Column, rows: Column) -> Column:
    return F.try_divide(total.cast("double"), rows.cast("double") * F.lit(UNITS_PER_ONE))


def mean_of_ratio(c: str | Column) -> Column:
    """Aggregate: average of a double column."""
    return mean_of_units(F.sum(ratio_units(c)), F.count(_col(c)))
