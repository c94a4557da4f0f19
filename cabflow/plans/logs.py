"""Landed logs to typed tables, one day at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cabflow.operators.filters import parsed
from cabflow.operators.picking import compact_changes, latest_per_key
from cabflow.operators.shaping import project, renamed
from cabflow.schemas import LOGS, LogSource, names, ods_schema
from cabflow.sinks.writers import partition_path, path_exists, write_partition
from cabflow.sources.tables import read_ods
from cabflow.sources.text import LINE, parse_delimited, parse_pattern


def parse_log(lines: DataFrame, source: LogSource) -> DataFrame:
    if source.pattern is not None:
        return parse_pattern(lines, source.pattern, source.schema)
    return parse_delimited(lines, source.schema, source.sep)


def typed_log(lines: DataFrame, name: str) -> DataFrame:
    """Rows of one day's lines: unparsable lines are gone, change logs are compacted.

    Columns beside the line, such as the hour, are kept behind those of the log.
    """
    source = LOGS[name]
    rows = parsed(parse_log(lines, source), source.key)
    if source.change_log:
        rows = compact_changes(rows, source.key, "update_time", "operation")
    extra = [c for c in rows.columns if c not in names(source.schema)]
    rows = project(rows, source.schema + [(c, "") for c in extra])
    new_names = dict(source.rename)
    return renamed(rows, {new_names.get(c, c): c for c in rows.columns})


def raw_lines(spark: SparkSession, name: str, raw: str, day: str) -> DataFrame:
    """The lines of one landed day; none if nothing was landed."""
    folder = partition_path(raw, dt=int(day))
    if path_exists(spark, folder):
        lines = spark.read.text(folder)
        # An hourly folder without hours holds no files.
        if not LOGS[name].by_hour or "hour" in lines.columns:
            return lines
    return spark.createDataFrame([], f"{LINE} string, hour int" if LOGS[name].by_hour else f"{LINE} string")


def convert_log(
    spark: SparkSession, name: str, raw: str, ods: str, day: str, hour: int | None = None
) -> str:
    """Replace one day of a table, or one hour; returns the folder written.

    A day of which nothing was landed becomes an empty one: rows of an earlier run do not stay.
    A whole day of an hourly log is one job.  Folders ``hour=1`` and ``hour=01`` are the
    same hour, because the partition value is read as a number.
    """
    source = LOGS[name]
    lines = raw_lines(spark, name, raw, day)
    if not source.by_hour:
        return write_partition(typed_log(lines, name), ods, dt=int(day))
    if hour is None:
        return write_partition(typed_log(lines, name), ods, by=["hour"], dt=int(day))
    rows = typed_log(lines.where(lines["hour"] == hour).drop("hour"), name)
    return write_partition(rows, ods, dt=int(day), hour=hour)


def current_state(
    spark: SparkSession, name: str, ods: str, dates: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of every id of a change log over several arrival days.

    A row lies in the day it arrived, so an older version may lie in a later day than a newer
    one; the time of the change decides, then the content.  ``dt`` is the day of the row that is
    left.  A deletion ends an id within its own day only.
    """
    rows = read_ods(spark, ods, dates, schema=ods_schema(name))
    return latest_per_key(rows, [LOGS[name].key], ["update_time"])
