"""Running numbers and sums within a key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cabflow.operators.picking import ColumnLike, _col
from cabflow.sinks.writers import staged


PART, GROUP, BUCKET = "_part", "_group", "_bucket"
#: Rows of a range of a table that is numbered: there are as many ranges as that asks for.
RANGE_ROWS = 1 << 17
#: More rows than this of one key are not sorted in one task.
HOT_ROWS = 1 << 20
#: Hashes of keys that are counted apart.
KEY_BUCKETS = 1 << 16


def _in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnLike], ranges: int | None) -> DataFrame:
    """The rows dealt into ranges of (keys, order), written with the number of their range.

    Without ``ranges`` there are as many as the session has shuffle partitions, at most.

    The keys stand in one struct, inside which missing values compare equal.  Written, because
    the bounds of the ranges are drawn anew whenever a plan is run again.
    """
    spark = df.sparkSession
    rows = df.withColumn(GROUP, F.struct(F.lit(0).alias("_"), *[F.col(k) for k in keys]))
    bounds = [GROUP, *[_col(c) for c in order]]
    dealt = rows.repartitionByRange(*bounds) if ranges is None else rows.repartitionByRange(ranges, *bounds)
    return staged(spark, dealt.withColumn(PART, F.spark_partition_id()), "parts")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
    out: str,
    value: ColumnLike | None = None,
    tiebreak: Sequence[ColumnLike] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Running sum of ``value`` (by default of ones) within each key, this row included.

    A key may hold far more rows than one task can sort, so the sum is put together on two
    levels.  Rows are dealt into ranges of key and order; within a range they are summed in
    order.  A key that goes on from one range into the next is the last of the one and the first
    of the other, so there are fewer such keys than ranges: their sums per range, again summed in
    order, are where each range starts.  No keys at all is one key.  Rows that are equal in keys,
    order and tiebreak may take each other's place; those are never torn apart, so ``order`` and
    ``tiebreak`` should tell the rows of a hot key apart.  Missing values are zero.  A task sorts
    whole ranges; ``ranges`` says how many there are.
    """
    order = [*order, *tiebreak]
    rows = _in_parts(df, keys, order, ranges)
    amount = F.lit(1).cast("bigint") if value is None else F.coalesce(_col(value), F.lit(0))
    ends = rows.groupBy(PART).agg(F.min(GROUP).alias("first"), F.max(GROUP).alias("last"))
    ends = ends.select(PART, F.explode(F.array_distinct(F.array("first", "last"))).alias(GROUP))
    torn = ends.groupBy(GROUP).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(GROUP)
    # Torn keys, and the ranges they lie in, are fewer than the ends of all ranges: small enough
    # to be sent to the rows, which a join by the key would bring together in one task.
    sums = rows.join(F.broadcast(torn), GROUP, "left_semi").groupBy(GROUP, PART).agg(F.sum(amount).alias("_sum"))
    before = W.partitionBy(GROUP).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(GROUP, PART, F.sum("_sum").over(before).alias("_start"))
    within = W.partitionBy(GROUP, PART).orderBy(*[_col(c) for c in order])
    if value is None:
        local = F.row_number().over(within).cast("bigint")
    else:
        local = F.sum(amount).over(within.rowsBetween(W.unboundedPreceding, W.currentRow))
    if ranges is not None:
        rows = rows.repartition(ranges, PART)
    joined = rows.join(F.broadcast(starts), [GROUP, PART], "left")
    return joined.withColumn(out, F.coalesce("_start", F.lit(0)) + local).select(*df.columns, out)


def batch_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
    out: str,
    tiebreak: Sequence[ColumnLike] = (),
) -> DataFrame:
    """Running number of each row within its key, from 1 (see :func:`running_total`).

    The rows are counted first, so that what a task sorts stays the same while the table grows.
    """
    ranges = math.ceil(df.count() / RANGE_ROWS)
    fewest = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return running_total(df, keys, order, out, tiebreak=tiebreak, ranges=ranges if ranges > fewest else None)


def hot_buckets(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hashes of keys that have more than ``hot_rows`` rows, written."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
    sizes = df.groupBy(bucket.alias(BUCKET)).agg(F.count(F.lit(1)).alias("_n"))
    return staged(df.sparkSession, sizes.where(F.col("_n") > hot_rows).select(BUCKET), "hot")


def number_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnLike],
    out: str,
    tiebreak: Sequence[ColumnLike] = (),
    counted: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Running number of each row within its key, from 1, where most keys are small.

    One window over the keys needs one shuffle and leaves the rows by key for what follows, but
    sorts a key in one task.  Rows are first counted by a hash of the key; those of a hash with
    more than ``hot_rows`` are numbered by :func:`batch_number`.  ``counted`` is a frame that
    holds the keys of all rows of ``df``, by default itself, and is cheaper to read.  ``hot`` is
    what :func:`hot_buckets` found in it, if that is known.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
    if hot is None:
        hot = hot_buckets(df if counted is None else counted, keys, hot_rows)
    window = W.partitionBy(*keys).orderBy(*[_col(c) for c in [*order, *tiebreak]])
    number = F.row_number().over(window).cast("bigint")
    if hot.isEmpty():
        return df.withColumn(out, number)
    dealt, hot = df.withColumn(BUCKET, bucket), F.broadcast(hot)
    small = dealt.join(hot, BUCKET, "left_anti").select(*df.columns, number.alias(out))
    large = dealt.join(hot, BUCKET, "left_semi").select(*df.columns)
    return small.unionByName(batch_number(large, keys, order, out, tiebreak))


def top_k_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
) -> DataFrame:
    """The first ``k`` rows per key.

    Spark cuts each map task's rows to ``k`` per key before the shuffle.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") <= k).drop("_rank")
