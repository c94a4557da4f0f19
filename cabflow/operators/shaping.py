"""Projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.schemas import Fields, names


def project(df: DataFrame, schema: Fields) -> DataFrame:
    """The columns of a schema in its order; partition columns are not part of it."""
    return df.select(*names(schema))


def renamed(df: DataFrame, columns: dict[str, str | Column]) -> DataFrame:
    """New name to old name or expression."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    )


def stamped(df: DataFrame, day: str) -> DataFrame:
    """The run day as a constant number."""
    return df.withColumn("dt", F.lit(int(day)))


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression is evaluated once per row.

    Filters on a plain computed column move below it and compute it again, which for a
    pattern or JSON text is most of the work.  They do not move below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_json(df: DataFrame, text: Column, columns: dict[str, str]) -> DataFrame:
    """Add top-level JSON fields as text, output name first; NULL where there are none."""
    fields = F.json_tuple(text, *columns.values()).alias(*columns)
    return df.select("*", fields)
