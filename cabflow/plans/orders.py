"""Finished orders of a city with what is known about them in the extension table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions.times import LOCAL_ZONE
from cabflow.operators.filters import finished, in_local_days, known, of_days
from cabflow.operators.joins import left_join
from cabflow.operators.picking import latest_per_key
from cabflow.operators.shaping import renamed, with_json

# Output columns of the order extract, new name first where it changes.
ORDER_COLUMNS = """
    dt city service_order_id product_type_id is_asap order_flag=flag account_id user_id driver_id
    corporate_id car_type_id car_type car_brand order_status=status rc_status
    order_reason_id=reason_id order_create_time=create_time arrival_time confirm_time start_time
    end_time start_position start_address end_position end_address expect_start_latitude
    expect_start_longitude expect_end_latitude expect_end_longitude start_latitude start_longitude
    end_latitude end_longitude coupon_name coupon_facevalue dependable_distance
    actual_time_length
"""


def name_map(text: str) -> dict[str, str]:
    """``"a b=c"`` gives ``{"a": "a", "b": "c"}``."""
    pairs = (item.partition("=") for item in text.split())
    return {new: old or new for new, _, old in pairs}


def finished_orders(
    orders: DataFrame, dates: Sequence[str] | None, city: str | None, tz: str = LOCAL_ZONE
) -> DataFrame:
    """All states of finished orders that were placed on the given local days."""
    rows = finished(of_days(orders, dates), city)
    return rows if dates is None else in_local_days(rows, "create_time", dates, tz)


def latest_orders(
    orders: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    tz: str = LOCAL_ZONE,
) -> DataFrame:
    """Last state of every finished order that was placed on the given local days."""
    rows = finished_orders(orders, dates, city, tz)
    columns = name_map(ORDER_COLUMNS)
    kept = renamed(rows, columns | {"_changed": "update_time"})
    return latest_per_key(kept, ["service_order_id"], ["_changed"]).drop("_changed")


def latest_extensions(ext: DataFrame, dates: Sequence[str] | None = None) -> DataFrame:
    """Last state of every extension row; its estimate is parsed once per order."""
    columns = ["user_type", "predict_amount", "deadhead_distance", "estimate_snap"]
    rows = of_days(ext, dates).select("service_order_id", "update_time", *columns)
    last = latest_per_key(rows, ["service_order_id"], ["update_time"])
    estimate = {"estimate_distance": "distance", "estimate_price": "estimate_price"}
    return with_json(last.drop("update_time"), F.col("estimate_snap"), estimate).drop(
        "estimate_snap"
    )


def order_base(
    orders: DataFrame,
    ext: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    tz: str = LOCAL_ZONE,
) -> DataFrame:
    """Orders with an estimate, one row each.

    Both sides are reduced to one row per order before they meet, so extension rows of
    other orders cost no more than one row per order and task.
    """
    joined = left_join(
        latest_orders(orders, dates, city, tz), latest_extensions(ext, dates), "service_order_id"
    )
    return known(joined, "estimate_distance")


def kept_orders(
    orders: DataFrame,
    ext: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    tz: str = LOCAL_ZONE,
) -> DataFrame:
    """Id and last update of the orders of :func:`order_base`, without their wide rows."""
    key = "service_order_id"
    last = finished_orders(orders, dates, city, tz).groupBy(key).agg(F.max("update_time").alias("update_time"))
    estimated = known(latest_extensions(ext, dates), "estimate_distance").select(key)
    return last.join(estimated, key, "left_semi")
