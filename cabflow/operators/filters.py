"""Row filters.  A condition that is unknown drops the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.times import LOCAL_ZONE, day_bounds

# Order states that are final.
FINAL_STATES = (7, 8)


def of_days(df: DataFrame, dates: Sequence[str] | None) -> DataFrame:
    """Days by partition, all of them without a list."""
    if dates is None:
        return df
    return df.where(F.col("dt").isin([int(d) for d in dates]))


def of_city(df: DataFrame, city: str | None) -> DataFrame:
    return df if city is None else df.where(F.col("city") == city)


def finished(df: DataFrame, city: str | None = None) -> DataFrame:
    return of_city(df, city).where(F.col("status").isin(*FINAL_STATES))


def in_local_days(df: DataFrame, ts: str, dates: Sequence[str], tz: str = LOCAL_ZONE) -> DataFrame:
    """Epoch seconds from the start of the first day to the last second of the last."""
    first, last = day_bounds(min(dates), tz)[0], day_bounds(max(dates), tz)[1]
    return df.where(F.col(ts).between(first, last))


def parsed(df: DataFrame, key: str) -> DataFrame:
    """Lines that had a key."""
    return df.where(F.col(key).isNotNull())


def with_value(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)


def no_contradiction(df: DataFrame) -> DataFrame:
    """Drop orders that dispatched a surcharge which no pricing log explains."""
    unexplained = (F.col("final_max_bidding_rate") > 0) & F.col("end_bidding_round").isNull()
    return df.where(~unexplained)


def complete(df: DataFrame) -> DataFrame:
    """Orders that have dispatch and supply figures."""
    return df.where(
        (F.col("avg_can_dispatch") >= 0)
        & (F.col("abs_demand") >= 0)
        & (F.col("relative_supply") >= 0)
    )


def risk_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_rc") == "T")


def date_prefix(df: DataFrame, day: str, column: str = "dt") -> DataFrame:
    return df.where(F.col(column).startswith(day))


def priced(df: DataFrame, decided: bool = False) -> DataFrame:
    """Dispatch rounds with a pricing id, and with a driver if asked for."""
    df = with_value(df, "bidding_id")
    return with_value(df, "decision_driver_id") if decided else df


def known(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def changed_not_deleted(op: str) -> Column:
    return F.col(op) != "DELETE"
