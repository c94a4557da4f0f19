"""Aggregates of orders, rounds, drivers, users and cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cabflow.functions.geo import geo_time_key, geohash
from cabflow.functions.rules import (
    accept_flag,
    is_accepted,
    is_decided,
    is_surcharged,
    or_minus1,
    ratio,
)
from cabflow.functions.times import wait_time
from cabflow.operators.numbering import top_k_per_key

QUARTILES = (25, 50, 75)


def round_total_columns() -> list[Column]:
    """Totals over the rounds of an order."""

    def mean(column: str) -> Column:
        return F.round(F.avg(column), 0)

    return [
        F.max("round").alias("max_round"),
        mean("can_dispatch_count").alias("avg_can_dispatch"),
        F.sum("can_dispatch_count").alias("sum_can_dispatch"),
        mean("dispatch_count").alias("avg_dispatch_count"),
        F.sum("dispatch_count").alias("sum_dispatch"),
        mean("response_count").alias("avg_response_count"),
        F.sum("response_count").alias("sum_response"),
        F.sum("accept_count").alias("sum_accept"),
    ]


def round_totals(info: DataFrame) -> DataFrame:
    return info.groupBy("service_order_id").agg(*round_total_columns())


# The distance and time measures of which a batch keeps the spread.
SPREADS = ("route_distance", "route_time_length", "distance", "distance_time_length")


def batch_stats(detail: DataFrame) -> DataFrame:
    """One row per order, round and batch from one row per candidate driver."""
    spread = []
    for column in SPREADS:
        spread += [
            F.min(column).alias(f"min_{column}"),
            F.avg(column).alias(f"avg_{column}"),
            F.max(column).alias(f"max_{column}"),
        ]
    return detail.groupBy("service_order_id", "round", "batch").agg(
        F.max("datetime").alias("datetime"),
        F.count("driver_id").alias("dispatch_count"),
        F.max("dispatch_time").alias("dispatch_time"),
        F.count_if(F.col("accept_status") == 1).alias("accept_count"),
        F.max("response_time").alias("response_time"),
        F.max(F.when(F.col("decision_result") == 2, 1).otherwise(0)).alias("decision_complete"),
        F.max("decision_time").alias("decision_time"),
        F.min("driver_bidding_rate").alias("min_bidding_rate"),
        F.max("driver_bidding_rate").alias("max_bidding_rate"),
        F.min("driver_estimate_price").alias("min_price"),
        F.max("driver_estimate_price").alias("max_price"),
        *spread,
    )


def order_extremes(detail: DataFrame) -> DataFrame:
    """Highest rate offered and first dispatch per order."""
    return detail.groupBy("service_order_id").agg(
        F.max("driver_bidding_rate").alias("final_max_bidding_rate"),
        F.min("dispatch_time").alias("min_dispatch_time"),
    )


# -- users ---------------------------------------------------------------------


def _indicators(orders: DataFrame) -> DataFrame:
    driver, rate = F.col("final_decision_driver_id"), F.col("final_driver_bidding_rate")
    return orders.withColumns(
        {
            "_decided": is_decided(driver),
            "_surcharged": is_surcharged(rate, F.col("final_max_bidding_rate")),
            "_accepted": is_accepted(driver, rate),
        }
    )


def _surcharge_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("user_order_count"),
        F.sum("_surcharged").alias("user_bidding_count"),
        F.sum("_accepted").alias("user_bidding_ok_count"),
    ]


def _rate_columns() -> list[Column]:
    """Distribution of the accepted rates; the rest of the orders count as NULL."""
    accepted = F.when(F.col("_accepted") == 1, F.col("final_driver_bidding_rate").cast("float"))
    return [
        F.avg(accepted).alias("user_accept_avg_bidding_rate"),
        F.percentile_approx(accepted, [q / 100 for q in QUARTILES]).alias("_quartiles"),
    ]


def _wait_columns() -> list[Column]:
    wait = wait_time(F.col("final_decision_time"), F.col("min_dispatch_time"))
    return [
        F.avg(wait).alias("user_mean_wait_time"),
        F.sum("_decided").alias("user_order_decision_ok_count"),
    ]


def _finish_surcharge(df: DataFrame) -> DataFrame:
    surcharged, accepted = F.col("user_bidding_count"), F.col("user_bidding_ok_count")
    return df.withColumns(
        {
            "user_bidding_accept_flag": accept_flag(surcharged, accepted),
            "user_bidding_accept_pct": or_minus1(ratio(accepted, surcharged)),
        }
    )


def _quartile(index: int) -> Column:
    return F.get("_quartiles", F.lit(index)).cast("double")


def _finish_rates(df: DataFrame) -> DataFrame:
    columns = {"user_accept_avg_bidding_rate": or_minus1(F.col("user_accept_avg_bidding_rate"))}
    for index, q in enumerate(QUARTILES):
        columns[f"user_accept_{q}pct_bidding_rate"] = or_minus1(_quartile(index))
    return df.withColumns(columns).drop("_quartiles")


def user_totals(orders: DataFrame) -> DataFrame:
    """Orders, waits and surcharges per user."""
    grouped = _indicators(orders).groupBy("user_id").agg(*_surcharge_columns(), *_wait_columns())
    return _finish_surcharge(grouped)


def rate_quantiles(orders: DataFrame) -> DataFrame:
    """Mean and quartiles of the accepted rates of the users that have any."""
    accepted = _indicators(orders).where(F.col("_accepted") == 1)
    return _finish_rates(accepted.groupBy("user_id").agg(*_rate_columns()))


def recent_wait(orders: DataFrame, k: int = 2, by: str = "user") -> DataFrame:
    """Mean wait over the latest ``k`` orders of each user.

    ``by="order"`` ranks within an order instead, which keeps every order.
    """
    waits = orders.select(
        "user_id",
        "service_order_id",
        "final_decision_time",
        wait_time(F.col("final_decision_time"), F.col("min_dispatch_time")).alias("_wait"),
    )
    keys = {"user": ["user_id"], "order": ["service_order_id"]}[by]
    newest = [F.desc("final_decision_time"), F.desc("service_order_id"), F.desc("_wait")]
    recent = top_k_per_key(waits, keys, newest, k)
    return recent.groupBy("user_id").agg(F.avg("_wait").alias("user_mean_wait_time_topk"))


PROFILE_COLUMNS = (
    "user_order_count",
    "user_order_decision_ok_count",
    "order_decision_ok_pct",
    "user_mean_wait_time",
    "user_mean_wait_time_topk",
    "user_bidding_count",
    "user_bidding_ok_count",
    "user_bidding_accept_flag",
    "user_bidding_accept_pct",
    "user_accept_avg_bidding_rate",
    *[f"user_accept_{q}pct_bidding_rate" for q in QUARTILES],
)


def user_profile(orders: DataFrame, k: int = 2, by: str = "user") -> DataFrame:
    """The full profile: totals and rates in one aggregate, plus the recent waits."""
    grouped = (
        _indicators(orders)
        .groupBy("user_id")
        .agg(*_surcharge_columns(), *_wait_columns(), *_rate_columns())
    )
    profile = _finish_rates(_finish_surcharge(grouped)).withColumn(
        "order_decision_ok_pct",
        ratio(F.col("user_order_decision_ok_count"), F.col("user_order_count")),
    )
    # A user without an id matches no recent wait, as in any join on a missing key.
    recent = recent_wait(orders, k, by)
    joined = profile.join(recent, "user_id", "left")
    return joined.select(F.col("user_id").alias("uid"), *PROFILE_COLUMNS)


def order_profile(orders: DataFrame) -> DataFrame:
    """The shorter profile that needs merged orders only."""
    grouped = (
        _indicators(orders).groupBy("user_id").agg(*_surcharge_columns(), *_rate_columns())
    )
    return _finish_rates(_finish_surcharge(grouped))


# -- cells ---------------------------------------------------------------------


def supply_demand(orders: DataFrame) -> DataFrame:
    """Demand and relative supply per cell and five minutes."""
    key = geo_time_key(
        F.col("order_create_time"),
        F.col("expect_start_latitude"),
        F.col("expect_start_longitude"),
    )
    return (
        orders.select(key.alias("geo_time_key"), "pre_availableDriverNum")
        .groupBy("geo_time_key")
        .agg(*supply_demand_columns())
    )


def supply_demand_columns() -> list[Column]:
    available = F.col("pre_availableDriverNum").cast("double")
    orders = F.count(F.lit(1))
    return [
        orders.alias("abs_demand"),
        (F.avg(available) / (orders + 1)).alias("relative_supply"),
    ]


def geo_stats(orders: DataFrame) -> DataFrame:
    """Orders and surcharges per cell."""
    driver, rate = F.col("final_decision_driver_id"), F.col("final_driver_bidding_rate")
    grouped = (
        orders.select(
            geohash(F.col("expect_start_latitude"), F.col("expect_start_longitude")).alias("geo"),
            is_surcharged(rate, F.col("final_max_bidding_rate")).alias("_surcharged"),
            is_accepted(driver, rate).alias("_accepted"),
        )
        .groupBy("geo")
        .agg(
            F.count(F.lit(1)).alias("geo_order_count"),
            F.sum("_surcharged").alias("geo_bidding_count"),
            F.sum("_accepted").alias("geo_bidding_ok_count"),
        )
    )
    return grouped.withColumns(
        {
            "geo_bidding_pct": or_minus1(ratio(F.col("geo_bidding_count"), F.col("geo_order_count"))),
            "geo_bidding_ok_pct": or_minus1(
                ratio(F.col("geo_bidding_ok_count"), F.col("geo_bidding_count"))
            ),
        }
    )


# -- KPI and checks ------------------------------------------------------------


def distinct_orders(df: DataFrame, where: Column | None = None) -> DataFrame:
    """Number of distinct orders."""
    if where is not None:
        df = df.where(where)
    return df.agg(F.count_distinct("service_order_id").alias("orders"))


def kpi_rows(info: DataFrame) -> DataFrame:
    """The three dispatch KPIs as ``key, value, datetime`` rows.

    Each order is reduced to "ever decided" first, so both distinct counts come from
    one shuffle of one row per order and task.
    """
    orders = (
        info.where((F.col("bidding_id") > 0) & F.col("service_order_id").isNotNull())
        .groupBy("service_order_id")
        .agg(F.max(is_decided(F.col("decision_driver_id"))).alias("_decided"))
    )
    counts = orders.agg(
        F.coalesce(F.sum("_decided"), F.lit(0)).alias("_succ"),
        F.count(F.lit(1)).alias("_all"),
    )
    rate = F.round(ratio(F.col("_succ"), F.col("_all")), 4)
    rows = counts.select(
        F.explode(
            F.array(
                kpi("dispatch_succ_rate", rate),
                kpi("dispatch_count_succ", F.col("_succ")),
                kpi("dispatch_count_all", F.col("_all")),
            )
        ).alias("_kpi")
    )
    return rows.select("_kpi.*")


def kpi(key: str, value: Column, period: str = "0") -> Column:
    """One KPI; the value is text with four decimals."""
    return F.struct(
        F.lit(key).alias("key"),
        F.when(value.isNotNull(), F.format_string("%.4f", value.cast("double"))).alias("value"),
        F.lit(period).alias("datetime"),
    )


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame and a row count that its own action fills in."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


class RowCounts:
    """Row counts of several frames of one plan, filled in by the action that runs it.

    No frame is computed a second time to be counted.
    """

    def __init__(self) -> None:
        self._observations: dict[str, Observation] = {}

    def watch(self, name: str, df: DataFrame) -> DataFrame:
        df, self._observations[name] = observed(df, name)
        return df

    def rows(self) -> dict[str, int]:
        """Waits for the action; a part that it could leave out altogether had no rows."""
        return {name: found.get.get("rows", 0) for name, found in self._observations.items()}


def counts_by(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def check_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """How many rows satisfy each condition, from one pass."""
    return df.agg(*[F.count_if(check).alias(name) for name, check in checks.items()])
