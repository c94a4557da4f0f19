"""Topics to text folders by arrival time."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cabflow.functions.times import LOCAL_ZONE, local_time
from cabflow.sources.text import LINE

# Fixed value: how often a new set of files is begun.
ROLL = "10 minutes"

# Topics whose folders are also split by hour.
HOURLY_TOPICS = frozenset({"dispatch_detail"})


def with_arrival(
    lines: DataFrame, by_hour: bool, tz: str = LOCAL_ZONE, arrived: Column | None = None
) -> DataFrame:
    """Add the local day, and hour, at which a line is landed.

    A line that comes late is in the day it came; the batch jobs keep the latest state
    per id (``cabflow.plans.logs.current_state``), which is what puts such lines right.
    ``arrived``, in epoch seconds, takes the place of the clock when a topic is played again.
    """
    now = local_time(F.unix_timestamp(F.current_timestamp()) if arrived is None else arrived, tz)
    columns = {"dt": F.date_format(now, "yyyyMMdd").cast("int")}
    if by_hour:
        columns["hour"] = F.hour(now)
    return lines.select(LINE).withColumns(columns)


def land_stream(
    lines: DataFrame,
    base: str,
    checkpoint: str,
    by_hour: bool = False,
    available_now: bool = False,
    fmt: str = "text",
    tz: str = LOCAL_ZONE,
    roll: str = ROLL,
    arrived: Column | None = None,
) -> StreamingQuery:
    """Write lines to ``dt=…[/hour=…]``; the checkpoint makes restarts lose nothing.

    A set of files is begun every ``roll``; with ``available_now`` what is there is landed at
    once, and the query ends.
    """
    trigger = {"availableNow": True} if available_now else {"processingTime": roll}
    by = ["dt", "hour"] if by_hour else ["dt"]
    return (
        with_arrival(lines, by_hour, tz, arrived)
        .writeStream.format(fmt)
        .option("path", base)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*by)
        .trigger(**trigger)
        .start()
    )


class LandedLines(StreamingQueryListener):
    """Counts the lines of every query while it runs; ``spark.streams.addListener`` starts it.

    The counts come with the progress of each batch, so no folder is read to be counted.
    """

    def __init__(self) -> None:
        self._lines: dict[str, int] = {}
        self._lock = Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._lock:
            key = str(event.progress.id)
            self._lines[key] = self._lines.get(key, 0) + event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def of(self, query: StreamingQuery) -> int:
        """Lines of a query so far; its id stays the same when it is started again."""
        with self._lock:
            return self._lines.get(str(query.id), 0)
