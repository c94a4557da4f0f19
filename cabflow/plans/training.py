"""Merged orders and the labelled training table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions.geo import geo_time_key, geohash
from cabflow.functions.rules import decision_type, label, rate_adjust
from cabflow.operators.aggregates import geo_stats, supply_demand
from cabflow.operators.filters import complete, known, no_contradiction
from cabflow.operators.joins import left_join, same


KEY = "service_order_id"


def merged_order(orders: DataFrame, dispatch: DataFrame, prices: DataFrame, asked: DataFrame) -> DataFrame:
    """Orders with their dispatch and pricing, without those that contradict each other.

    ``asked`` holds, once each, every pricing id that an order had in its rounds.  Prices come to
    the order through it, so that the wide rows are not shuffled by pricing id.
    """
    joined = left_join(orders, dispatch.drop("city"), KEY)
    offers = asked.withColumnRenamed(KEY, "_order").join(prices, "bidding_id")
    offers = offers.withColumnRenamed("bidding_id", "_asked")
    of_order = (F.col(KEY) == F.col("_order")) & same(F.col("bidding_id"), F.col("_asked"))
    joined = joined.join(offers, of_order, "left").drop("_order", "_asked")
    return no_contradiction(joined).withColumn(
        "decision_type_flag", decision_type(F.col("dispatch_flag"))
    )


def with_cells(orders: DataFrame) -> DataFrame:
    """Adds the cell and time slot of a row (``_cell``) and its cell (``expect_geohash``)."""
    lat, lon = F.col("expect_start_latitude"), F.col("expect_start_longitude")
    return orders.withColumns(
        {
            "_cell": geo_time_key(F.col("order_create_time"), lat, lon),
            "expect_geohash": geohash(lat, lon),
        }
    )


def demand_of(merged: DataFrame) -> DataFrame:
    return known(supply_demand(merged), "geo_time_key")


def _of_cells(merged: DataFrame) -> DataFrame:
    return known(geo_stats(merged), "geo")


def _by_row(cells: DataFrame, merged: DataFrame, profile: DataFrame) -> DataFrame:
    """Features of each row's own cell and time slot, and of its user.

    The key starts with the cell, so the statistics join the few rows of supply and demand.  All
    features are brought to the order, cell and user alone and from there to the wide rows, which
    are shuffled by their order at most, and not where they are dealt by it already.  Merged
    orders have an id.
    """
    slots = demand_of(merged).withColumn("_geo", F.substring_index("geo_time_key", "_", 1))
    slots = left_join(slots, _of_cells(merged), "_geo", "geo").drop("_geo")
    place = F.struct("_cell", "user_id")
    places = cells.select(KEY, "_cell", "user_id").distinct()
    found = left_join(places, slots, "_cell", "geo_time_key", often_missing=True)
    found = left_join(found, profile, "user_id", "uid", often_missing=True)
    found = found.select(F.col(KEY).alias("_order"), place.alias("_place"), *found.columns[3:])
    of_row = (F.col(KEY) == F.col("_order")) & same(place, F.col("_place"))
    return cells.join(found, of_row, "left").drop("_order", "_place")


def with_demand_of_order(cells: DataFrame, demand: DataFrame) -> DataFrame:
    """Every row with the supply and demand of each row of the same order.

    ``n`` rows of an order become ``n`` times ``n``.
    """
    of_rows = cells.select(F.col("service_order_id").alias("_oid"), "_cell")
    slots = left_join(of_rows, demand, "_cell", "geo_time_key", often_missing=True)
    return left_join(cells, slots.drop("_cell"), "service_order_id", "_oid")


def _by_order(cells: DataFrame, merged: DataFrame, profile: DataFrame) -> DataFrame:
    joined = with_demand_of_order(cells, demand_of(merged))
    joined = left_join(joined, _of_cells(merged), "expect_geohash", "geo", often_missing=True)
    return left_join(complete(joined), profile, "user_id", "uid", often_missing=True)


FAN_OUTS = {"row": _by_row, "order": _by_order}


def training_features(
    merged: DataFrame, profile: DataFrame, fan_out: str = "row"
) -> DataFrame:
    """Merged orders with supply and demand, user profile and cell statistics.

    An order with two pricing rows stays two rows.  ``fan_out="order"`` joins supply and
    demand by order id instead of by row, which makes them four.  Orders without supply
    figures are left out; those have no cell either.
    """
    if fan_out not in FAN_OUTS:
        raise ValueError(f"fan_out must be 'row' or 'order', not {fan_out!r}")
    return complete(FAN_OUTS[fan_out](with_cells(merged), merged, profile).drop("_cell"))


def labelled(features: DataFrame) -> DataFrame:
    """Add the adjusted rate and the label."""
    driver = F.col("final_decision_driver_id")
    rate, end_rate = F.col("final_driver_bidding_rate"), F.col("end_max_bidding_rate")
    return features.withColumns(
        {
            "bidding_rate_adjust": rate_adjust(
                driver, rate, F.col("final_max_bidding_rate"), end_rate
            ),
            "label": label(driver, rate, end_rate),
        }
    )


def training_table(merged: DataFrame, profile: DataFrame, fan_out: str = "row") -> DataFrame:
    return labelled(training_features(merged, profile, fan_out))
