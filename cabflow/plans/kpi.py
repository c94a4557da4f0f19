"""Dispatch KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.operators.aggregates import kpi_rows
from cabflow.sinks.writers import merge_path

KPI_KEYS = ["key", "datetime"]


def kpi_table(rows: DataFrame) -> DataFrame:
    """KPI rows in the shape of the KPI table."""
    return rows.select(
        "key",
        "datetime",
        "value",
        F.current_timestamp().alias("update_time"),
        F.lit(None).cast("string").alias("ext"),
    )


def refresh_dispatch_kpi(spark: SparkSession, info: DataFrame, path: str) -> None:
    """Compute the KPIs and merge them into the KPI table by key and period."""
    merge_path(spark, kpi_table(kpi_rows(info)), path, KPI_KEYS)
