"""Joins and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    right_key: str | None = None,
    often_missing: bool = False,
) -> DataFrame:
    """Left join that drops the key of the right side.

    A missing key matches nothing, yet all its rows would meet in one task.  With
    ``often_missing`` they get a second key made from their content and so spread out;
    this is off by default because it gives up a partitioning by the key alone.  Hot keys
    that do have a value are left to the adaptive skew join, which splits the left side.
    """
    right = right.withColumnRenamed(right_key or on, "_right_key")
    if not often_missing:
        return left.join(right, F.col(on) == F.col("_right_key"), "left").drop("_right_key")
    # The whole hash: rows without a key go to as many places as there are.
    spread = F.when(F.col(on).isNull(), F.xxhash64(*left.columns)).otherwise(F.lit(0).cast("bigint"))
    # Zero for every key, but not a literal, which would drop out of the join keys.
    zero = F.pmod(F.xxhash64(F.col("_right_key")), F.lit(1).cast("bigint"))
    joined = left.withColumn("_spread", spread).join(
        right.withColumn("_zero", zero),
        (F.col(on) == F.col("_right_key")) & (F.col("_spread") == F.col("_zero")),
        "left",
    )
    return joined.drop("_spread", "_zero", "_right_key")


def same(a: Column, b: Column) -> Column:
    """Equal, for a join whose sides stay dealt by its other keys: this is none of them.

    A missing value is equal to nothing; inside a struct it is equal to another missing one.
    """
    return a.between(b, b)


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``.

    The key side is reduced to distinct values first: a semi join cannot split it, and
    the partial aggregate is what removes a hot key.
    """
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def with_group_stats(df: DataFrame, by: str, stats: Sequence[Column]) -> DataFrame:
    """Every row with the aggregates of its group."""
    grouped = df.where(F.col(by).isNotNull()).groupBy(by).agg(*stats)
    return left_join(df, grouped, by, often_missing=True)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key it does not hold."""
    kept = old.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
