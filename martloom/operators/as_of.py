"""The version that is valid at a time, for many times at once: a merge of two sorted sequences per key, no range join.

Versions and times of a key stand in one sequence, and the last version is carried forward to each time. A key that holds a
third of all rows is cut twice: its times are distinct before they are sorted, and the sequence is split into months, each
of which is begun by the version carried into it. What is carried in is found on a short sequence of versions and months.
Facts meet the versions of their key as a list, one row per key, and take theirs from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CARRIED, BEGINS, ASKED = 0, 1, 2  # the order of rows at one time


def _rows(df: DataFrame, kind: int, value: Column) -> DataFrame:
    return df.select("_key", "_span", "_at", F.lit(kind).alias("_kind"), value.alias("_payload"))


def _carried(df: DataFrame, *keys: str) -> DataFrame:
    """The asked rows, with the last version before them in the sequence."""
    so_far = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_payload", F.last("_payload", ignorenulls=True).over(so_far)).where(F.col("_kind") == ASKED)


def _opened(asked: DataFrame, known: DataFrame, span: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Times and versions with their month, and what each month that is asked for is begun with, if anything.

    Of a key, its versions and one row for each month stand in one sequence. A version that begins on the first day of a
    month comes after what is carried into it.
    """
    month = F.trunc("_at", span).alias("_span")
    spanned, changes = asked.select("*", month), known.select("*", month)
    starts = spanned.select("_key", "_span", F.date_sub("_span", 1).alias("_at")).distinct()
    nothing = F.lit(None).cast(known.schema["_payload"].dataType)
    opening = _carried(_rows(starts, ASKED, nothing).unionByName(_rows(changes, BEGINS, F.col("_payload"))), "_key")
    return spanned, changes, opening.where("_payload IS NOT NULL")


def as_of(
    times: DataFrame, versions: DataFrame, key: str, at: str, begins: str, payload: Sequence[str], span: str = "MONTH"
) -> DataFrame:
    """For each distinct (key, at) the payload of the last version of the key that begins at or before it.

    Times before the first version of their key have none and are left out, as are times and keys that are NULL. ``at`` and
    ``begins`` are dates; versions of one key begin on different days. ``span`` is the piece of time one task sorts.
    """
    asked = times.select(F.col(key).alias("_key"), F.col(at).alias("_at")).where("_key IS NOT NULL AND _at IS NOT NULL").distinct()
    known = versions.select(
        F.col(key).alias("_key"), F.col(begins).alias("_at"), F.struct(*[F.col(c) for c in payload]).alias("_payload")
    ).where("_key IS NOT NULL AND _at IS NOT NULL")
    nothing = F.lit(None).cast(known.schema["_payload"].dataType)
    spanned, changes, opening = _opened(asked, known, span)
    opening = opening.withColumn("_at", F.col("_span"))
    whole = (
        _rows(opening, CARRIED, F.col("_payload"))
        .unionByName(_rows(changes, BEGINS, F.col("_payload")))
        .unionByName(_rows(spanned, ASKED, nothing))
    )
    found = _carried(whole, "_key", "_span").where("_payload IS NOT NULL")
    return found.select(F.col("_key").alias(key), F.col("_at").alias(at), "_payload.*")


def _listed(versions: DataFrame, key: str, begins: str, payload: Sequence[str]) -> DataFrame:
    """One row per key with the time of its first version and its versions by the year they begin in: a list of years, each
    the time of its first version and the list of all of them, so that a time is held against one number per year and the days
    of one year at most."""
    known = versions.select(
        F.col(key).alias("_key"), F.col(begins).alias("_at"), F.struct(*[F.col(c) for c in payload]).alias("_payload")
    ).where("_key IS NOT NULL AND _at IS NOT NULL")
    # One shuffle does for both groups.
    by_year = known.repartition("_key").groupBy("_key", F.year("_at").alias("_year")).agg(
        F.min("_at").alias("_at"), F.collect_list(F.struct("_at", "_payload")).alias("_versions")
    )
    return by_year.groupBy("_key").agg(
        F.min("_at").alias("_first"), F.collect_list(F.struct("_at", "_versions")).alias("_years")
    )


def _last_begun(listed: Column, at: str) -> Column:
    """The entry with the latest ``_at`` that is not after ``at``; NULL if there is none."""
    begun = F.filter(listed, lambda v: v["_at"] <= F.col(at))
    return F.reduce(begun, F.get(begun, F.lit(0)), lambda a, v: F.when(v["_at"] >= a["_at"], v).otherwise(a))


def with_version(
    facts: DataFrame, versions: DataFrame, key: str, at: str, begins: str, payload: Sequence[str]
) -> DataFrame:
    """facts with the payload of the version valid on their day; facts without one are left out.

    A key's versions are one row, of at most one version per day. Facts meet it in a plain join on the key, whose hot keys
    Spark's skew-join rule splits: they are shuffled once, a version is shuffled once, and nothing is asked for by day.
    """
    there = facts.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumnRenamed(key, "_key")
    # A condition on plain columns: one on what is found in the lists would be worked out in the join, and again after it.
    met = there.join(_listed(versions, key, begins, payload), "_key").where(F.col(at) >= F.col("_first"))
    others = [c for c in facts.columns if c not in (key, at)]
    year = met.select(F.col("_key").alias(key), at, *others, _last_begun(F.col("_years"), at).alias("_year"))
    found = year.select(key, at, *others, _last_begun(F.col("_year._versions"), at).getField("_payload").alias("_payload"))
    return found.select(key, at, *others, "_payload.*")
