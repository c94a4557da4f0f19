"""Surcharge decisions per pricing id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cabflow.functions.payloads import number, payload_driver_rates, unescape
from cabflow.functions.times import LOCAL_ZONE, PRICING_TIME, to_epoch
from cabflow.operators.filters import known, of_city, of_days
from cabflow.operators.joins import left_join, union_all
from cabflow.operators.picking import any_per_key, latest_per_key
from cabflow.operators.shaping import with_json
from cabflow.sinks.writers import staged

KEY = "bidding_id"

# JSON names of the estimate, and decision types of the rounds.
ESTIMATE_FIELDS = ("productTypeId", "estimatePrice", "availableDriverNum", "M")
BY_SYSTEM, BY_DRIVER = 1, 2


def pricing_ids(info: DataFrame, dates: Sequence[str] | None, city: str | None) -> DataFrame:
    """Pricing ids of a city and who decided: the pricing logs themselves do not say where they
    are from."""
    rows = known(of_city(of_days(info, dates), city), KEY)
    by = lambda kind: F.max(F.coalesce(F.col("decision_type") == kind, F.lit(False)))
    return rows.groupBy(KEY).agg(by(BY_SYSTEM).alias("by_system"), by(BY_DRIVER).alias("by_driver"))


def _of_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows that are already one per id, if the id is among those given (one row each)."""
    return rows.join(ids.select(KEY), KEY, "left_semi")


def estimates(pre: DataFrame, ids: DataFrame, tz: str = LOCAL_ZONE) -> DataFrame:
    """One estimate per pricing id."""
    one = _of_ids(any_per_key(known(pre, KEY).select(KEY, "datetime", "data"), [KEY]), ids)
    named = {f"_{field}": field for field in ESTIMATE_FIELDS}
    return with_json(one, unescape(F.col("data")), named).select(
        to_epoch(F.col("datetime"), PRICING_TIME, tz).alias("datetime"),
        KEY,
        *[number(F.col(f"_{f}")).alias(f"pre_{f}") for f in ESTIMATE_FIELDS],
    )


def _last_rounds(rounds: DataFrame, ids: DataFrame) -> DataFrame:
    """The last round of each id; all of its rows where several have the same time.

    Rounds are cut first, so that the map side keeps the last of an id; the join that follows has
    the same partitioning.
    """
    kept = known(known(rounds, KEY), "order_id").select(KEY, "round", "datetime", "data")
    newest = W.partitionBy(KEY).orderBy(F.desc("round"), F.desc("datetime"))
    last = kept.withColumn("_rank", F.rank().over(newest)).where("_rank = 1").drop("_rank")
    return _of_ids(last, ids)


def _highest(last: DataFrame, low: Column, high: Column) -> DataFrame:
    """One row per id: rows of the same time are told apart by their rates as numbers, not by
    their text."""
    rates = last.select(
        KEY,
        F.col("round").alias("end_bidding_round"),
        low.alias("end_min_bidding_rate"),
        high.alias("end_max_bidding_rate"),
    )
    return latest_per_key(rates, [KEY], ["end_min_bidding_rate", "end_max_bidding_rate"])


def system_rates(rounds: DataFrame, ids: DataFrame) -> DataFrame:
    """Rate of the last round; the system offers all drivers the same."""
    last = with_json(
        _last_rounds(rounds, ids), unescape(F.col("data")), {"_rate": "totalMagnification"}
    )
    rate = number(F.col("_rate"))
    return _highest(last, rate, rate)


def personal_rates(rounds: DataFrame, ids: DataFrame) -> DataFrame:
    """Lowest and highest rate over the drivers of the last round."""
    rates = payload_driver_rates(unescape(F.col("data")))
    last = _last_rounds(rounds, ids).withColumn("_rates", rates)
    return _highest(last, F.col("_rates.low"), F.col("_rates.high"))


def pricing(
    pre: DataFrame,
    system: DataFrame,
    personal: DataFrame,
    info: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    tz: str = LOCAL_ZONE,
) -> DataFrame:
    """Estimates with the rates of the system's and the drivers' decisions.

    An id that occurs in both logs gives two rows.  The ids are few next to the rounds; written
    once, one pass over the rounds serves all three logs.
    """

    ids = staged(info.sparkSession, pricing_ids(info, dates, city), "pricing_ids")
    rates = union_all(
        system_rates(of_days(system, dates), ids.where("by_system")),
        personal_rates(of_days(personal, dates), ids.where("by_driver")),
    )
    return left_join(estimates(of_days(pre, dates), ids, tz), rates, KEY)
