"""Registry of queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The given tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function from the tables to a frame."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(build, dedent(sql).strip() if sql else None)
        return build

    return register
