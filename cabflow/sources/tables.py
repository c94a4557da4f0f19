"""Partitioned tables, relational tables and topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.operators.filters import of_city, of_days
from cabflow.sinks.writers import path_exists


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_ods(
    spark: SparkSession,
    base: str,
    dates: Sequence[str] | None,
    city: str | None = None,
    schema: str | None = None,
) -> DataFrame:
    """Some days of a table, and one city; other days' folders are not even listed.

    Days that are not there have no rows.  With a ``schema`` (partition columns included) no file
    is opened to find the columns; it is needed where none of the days may be there.
    """
    base = base.rstrip("/")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if dates is None:
        return of_city(reader.parquet(base), city)
    folders = [f"{base}/dt={day}" for day in dates]
    folders = [folder for folder in folders if path_exists(spark, folder)]
    if folders:
        table = reader.option("basePath", base).parquet(*folders)
    elif schema is not None:
        table = spark.createDataFrame([], schema)
    else:
        raise FileNotFoundError(f"{base} has none of the days {', '.join(dates)}, and no schema is given")
    return of_city(of_days(table, dates), city)


def merged_path(base: str, city: str, day: str) -> str:
    return f"{base}/{city}/{day}.parquet"


def read_days(spark: SparkSession, base: str, city: str, dates: Sequence[str]) -> DataFrame:
    """Daily files of one city as one frame, in one scan."""
    if not dates:
        raise ValueError("no dates given")
    return spark.read.parquet(*[merged_path(base, city, day) for day in dates])


def read_existing(
    spark: SparkSession, table: str, url: str | None = None, **options: str
) -> DataFrame | None:
    """A table if it exists: from the catalog, or over JDBC with a ``url``.

    Large relational tables need ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` among the options to be read in parallel.
    """
    if url is None:
        return spark.table(table) if spark.catalog.tableExists(table) else None
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if not _relational_exists(spark, table, url, options):
        return None
    return reader.load()


def _relational_exists(spark: SparkSession, table: str, url: str, options: dict[str, str]) -> bool:
    """Asks the database's catalog for one name, with its schema if it has one."""
    login = {k: v for k, v in options.items() if k in ("user", "password", "driver")}
    listing = "(select table_schema, table_name from information_schema.tables) listed"
    found = spark.read.format("jdbc").options(url=url, dbtable=listing, **login).load()
    schema, _, name = table.rpartition(".")
    found = found.where(F.col("table_name") == name)
    if schema:
        found = found.where(F.col("table_schema") == schema)
    return bool(found.head(1))


def stream_topic(spark: SparkSession, topic: str, **options: str) -> DataFrame:
    """A message topic as lines; ``path`` reads a folder of text files instead."""
    if "path" in options:
        return spark.readStream.format("text").options(**options).load()
    messages = spark.readStream.format("kafka").option("subscribe", topic).options(**options)
    return messages.load().selectExpr("cast(value as string) as value")
