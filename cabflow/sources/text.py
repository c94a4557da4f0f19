"""Text lines to typed columns.

The parsers work on any frame with a ``value`` column, so landed files and streams
share them.  Lines are split as text rather than read as CSV, which would turn empty
strings into NULL and give quotes a meaning they do not have in these logs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.functions.rules import typed
from cabflow.operators.shaping import with_once
from cabflow.schemas import Fields, names

LINE = "value"
# Fixed value: how the delimited logs write a missing field.
NULL_TOKEN = r"\N"


def _literal_pattern(sep: str) -> str:
    return "".join(f"\\{c}" if c in "|.\\^$*+?()[]{}" else c for c in sep)


def _others(lines: DataFrame) -> list[str]:
    return [c for c in lines.columns if c != LINE]


def parse_delimited(
    lines: DataFrame, schema: Fields, sep: str, null_token: str | None = NULL_TOKEN
) -> DataFrame:
    """Fields by position; missing ones and those of the wrong type are NULL.

    Columns beside the line, such as the partition, are kept.
    """
    parts = F.split(F.col(LINE), _literal_pattern(sep), -1)
    split = with_once(lines, "_parts", parts)

    def field(index: int, data_type: str) -> Column:
        text = F.get("_parts", F.lit(index))
        if null_token is not None:
            text = F.nullif(text, F.lit(null_token))
        return typed(text, data_type)

    columns = [field(i, t).alias(n) for i, (n, t) in enumerate(schema)]
    return split.select(*columns, *_others(lines))


# Stands between the groups of a matched line.
_MARK = "\u0001\u0002"


def parse_pattern(lines: DataFrame, pattern: str, schema: Fields) -> DataFrame:
    """Groups of a pattern by position; a line that does not match gives NULLs.

    One replacement puts a mark before every group, so the pattern runs once per line.
    Only a line that already holds the mark is matched group by group.
    """
    whole = rf"\A(?:{pattern})\z"
    count = len(schema)
    line = F.col(LINE)
    marked = F.regexp_replace(line, whole, "".join(f"{_MARK}${i + 1}" for i in range(count)))
    single = F.when(
        F.rlike(line, F.lit(whole)),
        F.array(F.lit(""), *[F.regexp_extract(line, whole, i + 1) for i in range(count)]),
    )
    groups = F.when(F.contains(line, F.lit(_MARK)), single).otherwise(F.split(marked, _MARK, -1))
    matched = with_once(lines, "_groups", groups)

    def group(index: int, data_type: str) -> Column:
        # Without a match the line itself is the only element.
        return typed(F.get("_groups", F.lit(index + 1)), data_type)

    columns = [group(i, t).alias(n) for i, (n, t) in enumerate(schema)]
    return matched.select(*columns, *_others(lines))


def read_delimited(spark: SparkSession, path: str, schema: Fields, sep: str) -> DataFrame:
    return parse_delimited(spark.read.text(path), schema, sep)


def read_pattern(spark: SparkSession, path: str, pattern: str, schema: Fields) -> DataFrame:
    return parse_pattern(spark.read.text(path), pattern, schema)


# -- tab-separated exports -----------------------------------------------------

TAB = "\t"


def _is_short(schema: Fields) -> Column:
    return F.size(F.split(F.col(LINE), TAB, -1)) < len(schema)


def parse_tsv(lines: DataFrame, schema: Fields, on_short: str = "fail") -> DataFrame:
    """Fields of an export; surplus fields are ignored.

    A line with too few fields stops the job, or is left out with ``on_short="skip"``
    (``short_lines`` gives those).
    """
    if on_short == "skip":
        lines = lines.where(~_is_short(schema))
    elif on_short == "fail":
        message = F.concat(F.lit("line with too few fields: "), F.col(LINE))
        checked = F.when(_is_short(schema), F.raise_error(message)).otherwise(F.col(LINE))
        lines = lines.withColumn(LINE, checked)
    else:
        raise ValueError(f"on_short must be 'fail' or 'skip', not {on_short!r}")
    return parse_delimited(lines, schema, TAB, null_token=None)


def short_lines(lines: DataFrame, schema: Fields) -> DataFrame:
    return lines.where(_is_short(schema))


def read_tsv(
    spark: SparkSession, path: str, schema: Fields, on_short: str = "fail"
) -> DataFrame:
    return parse_tsv(spark.read.text(path), schema, on_short)


def read_tsv_named(
    spark: SparkSession, path: str, schema: Fields, dates: Sequence[str] = ()
) -> DataFrame:
    """An export with given names, quoted text and some date columns; empty means NULL."""
    raw = ", ".join(f"`{name}` string" for name in names(schema))
    text = spark.read.schema(raw).option("sep", TAB).option("escape", '"').csv(path)
    return text.select(
        *[
            (F.try_to_timestamp(n) if n in dates else typed(F.col(n), t)).alias(n)
            for n, t in schema
        ]
    )
