"""Geohash cells as plain integer arithmetic, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cabflow.functions.times import floor_5min

# The geohash alphabet, and the digits that Spark writes numbers with.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _slot(value: Column, low: float, high: float, bits: int) -> Column:
    """Number of the half-open interval that holds ``value``, of ``2**bits`` equal ones.

    NULL where the value is missing or outside.
    """
    width = (high - low) / 2**bits
    rough = F.floor((value - low) / (high - low) * 2**bits)
    # value - low may round up onto the next boundary.
    exact = rough - (value < rough * width + low).cast("bigint")
    return F.when(value.between(low, high), F.least(exact, F.lit(2**bits - 1)))


def _every_other_bit(slot: Column) -> Column:
    """The bits of a number with a zero between each two: base 2 digits read in base 4."""
    return F.conv(F.bin(slot), 4, 10).cast("bigint")


def geohash(lat: Column, lon: Column, precision: int = 5) -> Column:
    """Geohash text; NULL where a coordinate is missing or out of range.

    Each coordinate occurs once in the expression, which keeps the generated code of a
    stage that groups by it small enough to be compiled.
    """
    bits = 5 * precision
    x = _every_other_bit(_slot(lon.cast("double"), -180.0, 180.0, (bits + 1) // 2))
    y = _every_other_bit(_slot(lat.cast("double"), -90.0, 90.0, bits // 2))
    # The first bit is one of the longitude; the last is so only for an odd count.
    code = x + y * 2 if bits % 2 else x * 2 + y
    number = F.conv(code.cast("string"), 10, 32)
    return F.translate(F.lpad(number, precision, "0"), DIGITS, ALPHABET)


def geo_time_key(epoch: Column, lat: Column, lon: Column) -> Column:
    """Cell and five-minute slot in one text; NULL where either is missing."""
    return F.concat(geohash(lat, lon), F.lit("_"), floor_5min(epoch).cast("string"))
