"""User profiles from dispatch history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.functions.times import LOCAL_ZONE, effective_time, to_epoch
from cabflow.operators.aggregates import order_extremes, user_profile
from cabflow.operators.filters import of_city, of_days
from cabflow.operators.joins import left_join
from cabflow.operators.picking import latest_per_key
from cabflow.sinks.writers import staged


def profile_base(
    info: DataFrame,
    detail: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    tz: str = LOCAL_ZONE,
) -> DataFrame:
    """Last dispatch round of each order with its candidates' extremes."""
    ended = effective_time(F.col("decision_time"), to_epoch(F.col("datetime"), tz=tz))
    rounds = of_city(of_days(info, dates), city).select(
        "service_order_id",
        ended.alias("final_decision_time"),
        "user_id",
        F.col("decision_driver_id").alias("final_decision_driver_id"),
        F.col("driver_bidding_rate").alias("final_driver_bidding_rate"),
    )
    last = latest_per_key(rounds, ["service_order_id"], ["final_decision_time"])
    candidates = order_extremes(of_city(of_days(detail, dates), city))
    return left_join(last, candidates, "service_order_id")


def stat_profile(
    info: DataFrame,
    detail: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    k: int = 2,
    by: str = "user",
    tz: str = LOCAL_ZONE,
) -> DataFrame:
    """One row per user; ``by="order"`` averages the recent wait over all orders."""
    return user_profile(profile_base(info, detail, dates, city, tz), k, by)


def staged_profile(
    spark: SparkSession,
    info: DataFrame,
    detail: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    k: int = 2,
    by: str = "user",
    tz: str = LOCAL_ZONE,
) -> DataFrame:
    """The same, with the rows per order written once instead of computed twice.

    The totals and the recent waits both read them, and they are small next to the log.
    """
    base = staged(spark, profile_base(info, detail, dates, city, tz), "profile")
    return user_profile(base, k, by)
