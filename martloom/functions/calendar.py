"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day numbers run from Sunday = 0; these two are the weekend.
WEEKEND_DAYS = (0, 6)


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer; grows with the date."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def day_of_week(day: Column) -> Column:
    return (F.dayofweek(day) - 1).cast("int")


def calendar_columns(day: Column) -> list[Column]:
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        day_of_week(day).alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_number"),
        F.monthname(day).alias("month_name"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year_number"),
        day_of_week(day).isin(*WEEKEND_DAYS).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
    ]
