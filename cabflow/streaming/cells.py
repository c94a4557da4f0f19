"""Demand and supply per cell and five minutes while orders come in.

The same figures as ``supply_demand`` gives over a stored day, from a stream: orders are put into
five-minute windows of the time they were placed, and a window is written once, when the watermark
has passed its end.  Until then its counts are kept in the state store.  An order that comes after
its window was written is not in the figures; :func:`accounts` says how many there were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabflow.functions.geo import geohash
from cabflow.operators.aggregates import supply_demand_columns

# Fixed value: length of a window.
SLOT = "5 minutes"
#: How long a window waits for orders that come late.
DELAY = "10 minutes"
SLOT_COLUMNS = "geo_time_key string, abs_demand long, relative_supply double"


def supply_demand_stream(orders: DataFrame, delay: str = DELAY) -> DataFrame:
    """Closed windows, as ``geo_time_key``, ``abs_demand`` and ``relative_supply``.

    Orders without a place or a time are in no cell and are left out.
    """
    placed = _placed(orders).withColumn("_at", F.timestamp_seconds("order_create_time"))
    slots = placed.withWatermark("_at", delay).groupBy(F.window("_at", SLOT).alias("_slot"), "_geo").agg(*supply_demand_columns())
    start = F.unix_timestamp("_slot.start").cast("string")
    return slots.select(F.concat("_geo", F.lit("_"), start).alias("geo_time_key"), "abs_demand", "relative_supply")


def _placed(orders: DataFrame) -> DataFrame:
    cell = geohash(F.col("expect_start_latitude"), F.col("expect_start_longitude"))
    rows = orders.select("order_create_time", "pre_availableDriverNum", cell.alias("_geo"))
    return rows.where(F.col("_geo").isNotNull() & F.col("order_create_time").isNotNull())


def start_supply_demand(
    orders: DataFrame,
    out: str,
    checkpoint: str,
    delay: str = DELAY,
    roll: str = "1 minute",
    available_now: bool = False,
) -> StreamingQuery:
    """Append closed windows to a Parquet folder; goes on from its checkpoint."""
    trigger = {"availableNow": True} if available_now else {"processingTime": roll}
    return (
        supply_demand_stream(orders, delay)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


@dataclass(frozen=True)
class Accounts:
    """Where the orders of a stream are: in written windows, in open ones, or late."""

    orders: int
    written: int
    open: int

    @property
    def late(self) -> int:
        return self.orders - self.written - self.open


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Start, cell and orders so far of the windows that are still in the state store."""
    state = spark.read.format("statestore").load(checkpoint)
    # The count is the first of the sums that are kept for a window.
    sums = state.select("key.*", F.col("value.*"))
    count = sums.columns[2]
    named = sums.toDF("_slot", "_geo", "abs_demand", *[f"_sum{i}" for i in range(len(sums.columns) - 3)])
    if count != "count":
        raise ValueError(f"the state of a window starts with {count!r}, not with the number of orders")
    return named.select("_slot", "_geo", "abs_demand")


def accounts(orders: DataFrame, out: str, checkpoint: str) -> Accounts:
    """Accounts of a stream that has stopped, over the stored ``orders`` it has read."""
    spark = orders.sparkSession
    total = lambda df: df.agg(F.coalesce(F.sum("abs_demand"), F.lit(0))).first()[0]
    written = spark.read.schema(SLOT_COLUMNS).parquet(out)
    return Accounts(_placed(orders).count(), total(written), total(open_windows(spark, checkpoint)))
