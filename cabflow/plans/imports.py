"""Daily exports of other systems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.functions.times import shift_day
from cabflow.operators.filters import date_prefix, risk_only
from cabflow.operators.joins import upsert
from cabflow.operators.picking import distinct_on
from cabflow.operators.shaping import project, stamped
from cabflow.schemas import DEVICE, IMPORTS, RISK_ORDER, ImportSource, fields, without
from cabflow.sinks.writers import (
    drop_partition,
    merge_path,
    partition_path,
    path_exists,
    staged,
    write_jdbc,
    write_overwrite,
    write_partition,
    write_sized,
)
from cabflow.sources.tables import read_existing
from cabflow.sources.text import LINE, parse_tsv, read_tsv_named

RETENTION_DAYS = 30
RISK_KEYS = ["service_order_id"]
VERSION_KEYS = ["service_order_id", "update_time"]


def export_rows(
    lines: DataFrame, source: ImportSource, day: str, on_short: str = "fail"
) -> DataFrame:
    """Rows of one day; tables that keep versions have one row per id and version."""
    rows = date_prefix(parse_tsv(lines, source.schema, on_short), day)
    if source.keep_versions:
        rows = distinct_on(rows, VERSION_KEYS)
    return project(rows, without(source.schema, "dt"))


def import_export(
    spark: SparkSession,
    name: str,
    folder: str,
    base: str,
    day: str,
    on_short: str = "fail",
    on_absent: str = "fail",
    part_bytes: int | None = None,
) -> str:
    """Replace one day of an imported table and drop the day that is 30 days older.

    Without an export of the day the import fails, or with ``on_absent="clear"`` the day becomes
    an empty one.  Files are as large as ``part_bytes`` says (see ``write_sized``); by default
    there is one for each part of the export.
    """
    source = IMPORTS[name]
    path = f"{folder}/{source.file_name}_{day}.tsv"
    if on_absent not in ("fail", "clear"):
        raise ValueError(f"on_absent must be 'fail' or 'clear', not {on_absent!r}")
    if on_absent == "clear" and not path_exists(spark, path):
        lines = spark.createDataFrame([], f"{LINE} string")
    else:
        lines = spark.read.text(path)
    rows = export_rows(lines, source, day, on_short)
    if part_bytes is None:
        target = write_partition(rows, base, dt=int(day))
    else:
        target = partition_path(base, dt=int(day))
        write_sized(rows, target, part_bytes)
    drop_partition(spark, base, shift_day(day, -RETENTION_DAYS))
    return target


def devices(spark: SparkSession, path: str, day: str) -> DataFrame:
    return stamped(read_tsv_named(spark, path, fields(DEVICE)), day)


def refresh_devices(
    spark: SparkSession, path: str, day: str, target: str, url: str | None = None, **options: str
) -> None:
    """Replace the device table: a Parquet folder, or a relational table with a ``url``."""
    rows = devices(spark, path, day)
    if url is None:
        write_overwrite(rows, target)
    else:
        write_jdbc(rows, url, target, **options)


def risk_orders(spark: SparkSession, path: str, day: str) -> DataFrame:
    rows = read_tsv_named(
        spark, path, fields(RISK_ORDER), dates=["create_time", "complete_time"]
    )
    return stamped(risk_only(rows), day)


def still_kept(day: str, keep_days: int) -> Column:
    return F.col("dt") > int(shift_day(day, -keep_days))


def merge_risk_orders(
    old: DataFrame | None, new: DataFrame, day: str, keep_days: int | None = None
) -> DataFrame:
    """New rows replace old ones of the same order; older days can be let go."""
    merged = new if old is None else upsert(old, new, RISK_KEYS)
    if keep_days is None:
        return merged
    return merged.where(still_kept(day, keep_days))


def update_risk_orders(
    spark: SparkSession,
    path: str,
    day: str,
    target: str,
    keep_days: int | None = None,
    url: str | None = None,
    **options: str,
) -> None:
    """Merge one day's risk orders into a Parquet folder or a relational table."""
    new = risk_orders(spark, path, day)
    if url is None:
        keep = None if keep_days is None else still_kept(day, keep_days)
        merge_path(spark, new, target, RISK_KEYS, keep)
        return
    old = read_existing(spark, target, url, **options)
    merged = merge_risk_orders(old, new, day, keep_days)
    if old is not None:
        # Writing empties the table that the rows are read from.
        merged = staged(spark, merged, "risk_orders")
    write_jdbc(merged, url, target, **options)
