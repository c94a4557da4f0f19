"""Columns taken out of JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unescape(text: Column) -> Column:
    r"""Turn ``\"`` back into ``"``."""
    return F.replace(text, F.lit('\\"'), F.lit('"'))


def json_fields(text: Column, *names: str) -> Column:
    """Named fields as one struct of strings, parsed once; nested objects stay text."""
    schema = ", ".join(f"`{name}` string" for name in names)
    return F.from_json(text, schema)


def number(text: Column) -> Column:
    """A rate or price held as text or as a quoted JSON number."""
    return text.try_cast("double")


DRIVERS = "map<string, struct<totalMagnification:string>>"


def driver_rates(driver_data: Column) -> Column:
    """Lowest and highest total rate in a map of drivers, as ``low`` and ``high``.

    Text that does not parse, an empty map and a driver without a rate all give 0.
    """
    return _extremes(F.from_json(driver_data, DRIVERS))


def payload_driver_rates(payload: Column) -> Column:
    """The same from the payload that holds the drivers as ``driverData``, parsed once.

    Drivers that are not an object there, such as quoted text, are taken out as text first.
    """
    within = F.from_json(payload, f"driverData {DRIVERS}")["driverData"]
    return _extremes(F.coalesce(within, F.from_json(F.get_json_object(payload, "$.driverData"), DRIVERS)))


def _extremes(drivers: Column) -> Column:
    def rates_of(found: Column) -> Column:
        return F.transform(F.map_values(found), lambda d: number(d["totalMagnification"]))

    def extremes(rates: Column) -> Column:
        whole = (F.size(rates) > 0) & ~F.exists(rates, lambda rate: rate.isNull())
        return F.struct(
            F.when(whole, F.array_min(rates)).otherwise(0.0).alias("low"),
            F.when(whole, F.array_max(rates)).otherwise(0.0).alias("high"),
        )

    # Each array of one element gives its value a name, so the text is parsed once.
    rates = F.transform(F.array(drivers), rates_of)
    return F.get(F.transform(rates, extremes), F.lit(0))
