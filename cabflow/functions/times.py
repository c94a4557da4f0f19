"""Time columns.

None of these depends on the session time zone: a local time is parsed together
with its zone, and an epoch second becomes local through a zone-free timestamp.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Shanghai"

# The two text formats of the logs.
LOG_TIME = "yyyy-MM-dd HH:mm:ss"
PRICING_TIME = "yyyy-MM-dd_HH:mm:ss"

FIVE_MINUTES = 300


def to_epoch(text: Column, fmt: str = LOG_TIME, tz: str = LOCAL_ZONE) -> Column:
    """Epoch seconds of a local time in text; NULL where it does not parse."""
    zoned = F.concat(text, F.lit(f" {tz}"))
    return F.unix_timestamp(F.try_to_timestamp(zoned, F.lit(f"{fmt} VV")))


def epoch_of(ts: Column) -> Column:
    """Whole epoch seconds of a zone-free timestamp that is read as UTC."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def local_time(epoch: Column, tz: str = LOCAL_ZONE) -> Column:
    """Zone-free wall-clock timestamp of an epoch second in ``tz``."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = start + F.make_dt_interval(secs=epoch.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def iso_weekday(epoch: Column, tz: str = LOCAL_ZONE) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(local_time(epoch, tz)) + 1


def hour_of_day(epoch: Column, tz: str = LOCAL_ZONE) -> Column:
    return F.hour(local_time(epoch, tz))


def floor_5min(epoch: Column) -> Column:
    seconds = epoch.cast("bigint")
    return seconds - F.pmod(seconds, F.lit(FIVE_MINUTES))


def effective_time(decision_time: Column, event_time: Column) -> Column:
    """The decision time where one was made, else the time of the record."""
    return F.when(decision_time > 0, decision_time).otherwise(event_time).cast("bigint")


def wait_time(decision: Column, first_dispatch: Column) -> Column:
    return decision - first_dispatch


# -- day lists, built on the driver -------------------------------------------


def _day(text: str) -> date:
    return datetime.strptime(text, "%Y%m%d").date()


def date_range(start: str, end: str, inclusive: bool = False) -> list[str]:
    """Days from ``start`` up to ``end``, which itself only counts if asked for."""
    first = _day(start)
    count = (_day(end) - first).days + int(inclusive)
    return [(first + timedelta(days=i)).strftime("%Y%m%d") for i in range(count)]


def shift_day(day: str, days: int) -> str:
    return (_day(day) + timedelta(days=days)).strftime("%Y%m%d")


def yesterday(tz: str = LOCAL_ZONE, now: datetime | None = None) -> str:
    now = (now or datetime.now(ZoneInfo(tz))).astimezone(ZoneInfo(tz))
    return (now.date() - timedelta(days=1)).strftime("%Y%m%d")


def day_bounds(day: str, tz: str = LOCAL_ZONE) -> tuple[int, int]:
    """Epoch seconds of 00:00:00 and 23:59:59 of a local day."""
    midnight = datetime.combine(_day(day), datetime.min.time(), ZoneInfo(tz))
    next_midnight = datetime.combine(
        _day(day) + timedelta(days=1), datetime.min.time(), ZoneInfo(tz)
    )
    return int(midnight.timestamp()), int(next_midnight.timestamp()) - 1
