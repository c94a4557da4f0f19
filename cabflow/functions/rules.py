"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of the dispatch flag and the words of the outcome columns.
SYSTEM_BIT = 1024
MANUAL_BIT = 512
UNKNOWN = "unkown"


def decision_type(flag: Column) -> Column:
    def has(bit: int) -> Column:
        return flag.bitwiseAND(F.lit(bit)) == bit

    return (
        F.when(has(SYSTEM_BIT), "system_decision")
        .when(has(MANUAL_BIT), "manual_decision")
        .otherwise(UNKNOWN)
    )


def _decided(driver: Column) -> Column:
    return driver > 0


def _undecided(driver: Column) -> Column:
    return (driver == 0) | driver.isNull()


def label(driver: Column, driver_rate: Column, end_rate: Column) -> Column:
    """Outcome of an order: was it surcharged, and did it find a driver."""
    surcharged = end_rate > 0
    plain = (end_rate == 0) | end_rate.isNull()
    return (
        F.when(_decided(driver) & (driver_rate > 0), "bidding_decision_ok")
        .when(surcharged & _undecided(driver), "bidding_decision_failed")
        .when(plain & _decided(driver), "no_bidding_decision_ok")
        .when(plain & _undecided(driver), "no_bidding_decision_failed")
        .otherwise(UNKNOWN)
    )


def rate_adjust(driver: Column, driver_rate: Column, max_rate: Column, end_rate: Column) -> Column:
    """The accepted rate of a decided order, else the last rate that was offered."""
    offered = (max_rate > 0) | (end_rate > 0)
    return (
        F.when(_decided(driver), driver_rate.cast("double"))
        .when(_undecided(driver) & offered, end_rate.cast("double"))
        .otherwise(F.lit(0.0))
    )


def accept_flag(surcharged: Column, accepted: Column) -> Column:
    """-1 never surcharged, 0 accepted none, 1 some, 2 all, -2 anything else."""
    return (
        F.when(surcharged == 0, -1)
        .when((surcharged > 0) & (accepted == 0), 0)
        .when((accepted > 0) & (surcharged > accepted), 1)
        .when((accepted > 0) & (surcharged == accepted), 2)
        .otherwise(-2)
    )


def flag01(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def is_decided(driver: Column) -> Column:
    return flag01(_decided(driver))


def is_surcharged(driver_rate: Column, max_rate: Column) -> Column:
    return flag01((driver_rate > 0) | (max_rate > 0))


def is_accepted(driver: Column, driver_rate: Column) -> Column:
    return flag01(_decided(driver) & (driver_rate > 0))


def or_minus1(value: Column) -> Column:
    return F.coalesce(value, F.lit(-1.0))


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as double; NULL for a zero denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def typed(text: Column, data_type: str) -> Column:
    """Cast that gives NULL for text of the wrong form.

    Empty text, the usual form of a missing value, is taken out first: a failing cast
    raises and catches an error for every field.
    """
    if data_type == "string":
        return text
    return F.nullif(text, F.lit("")).try_cast(data_type)
