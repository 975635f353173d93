"""Steps shared by the models."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.keys import surrogate_key


def no_value(kind: str) -> Column:
    return F.lit(None).cast(kind)


def current(dim: DataFrame) -> DataFrame:
    """The rows of a dimension that are valid now."""
    return dim.where("is_current")


def moment(when: datetime) -> Column:
    """A zoneless time as a literal. Spelled out as text: a datetime literal would pass through the local zone."""
    return F.lit(when.isoformat(" ")).cast("timestamp_ntz")


def stamped(df: DataFrame, run_ts: datetime | None, *names: str) -> DataFrame:
    """Audit columns: one instant for the whole run, the same in every task and every retry."""
    if run_ts is None:
        return df
    return df.select("*", *[moment(run_ts).alias(name) for name in names])


def days_table(calendar: DataFrame, *columns: str) -> DataFrame:
    """Calendar columns as a broadcast side.

    The bound is in the data type: one row per day, at most 3.65 million rows for the years 1 to 9999 and some ten
    thousand for any real range, of a few short columns each.
    """
    return F.broadcast(calendar.select(*columns))


def with_member_key(df: DataFrame, value: str, key: str, dim: DataFrame | None, dim_value: str) -> DataFrame:
    """Look up the key of a dimension that lists the distinct values of ``value``.

    Such a dimension holds every value of the column it was built from, and its key is a hash of that value. Without
    ``dim`` the lookup is therefore "not NULL, then hash": no shuffle, although a handful of values share all rows.
    With ``dim`` (a stored or edited list) it is an inner join; Spark broadcasts the list if it finds it small.
    """
    if dim is None:
        return df.where(F.col(value).isNotNull()).withColumn(key, surrogate_key(value))
    return df.join(dim.select(F.col(dim_value).alias(value), key), value)
