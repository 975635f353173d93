"""Readers for the ten input tables kept as files, and the two ways a model is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martloom.session import shuffles_dropped
from martloom.sources.schemas import TABLES, ddl


def read_csv_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One CSV file (or folder of CSV files) with a header row; an empty field is NULL.

    The schema is given, never inferred: inference would turn the postal code 02101 into 2101. A header that does not
    match, or a value that does not parse, fails the job instead of turning into NULL.
    """
    return (
        spark.read.schema(ddl(table))
        .options(header=True, enforceSchema=False, quote='"', escape='"', mode="FAILFAST")
        .csv(f"{folder.rstrip('/')}/{table}.csv")
    )


def read_parquet_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(ddl(table)).parquet(f"{folder.rstrip('/')}/{table}.parquet")


def read_tables(spark: SparkSession, folder: str, reader=read_csv_table) -> dict[str, DataFrame]:
    """All ten inputs, by table name; nothing is read until a query needs it."""
    return {table: reader(spark, folder, table) for table in TABLES}


def save_view(df: DataFrame, name: str) -> DataFrame:
    """The view sink: a name for the query, no stored rows."""
    df.createOrReplaceTempView(name)
    return df


def save_table(df: DataFrame, path: str) -> DataFrame:
    """The full-refresh sink: replace the stored table, then read it back."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
