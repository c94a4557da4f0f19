"""The training run: four extracts and a merge per day, then features over all days."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cabflow.functions.times import LOCAL_ZONE
from cabflow.operators.aggregates import RowCounts
from cabflow.operators.filters import known, of_days
from cabflow.operators.key_bits import KeyBits
from cabflow.plans.dispatch import dispatch_candidates, dispatch_info_extract, dispatch_merged
from cabflow.plans.orders import kept_orders, order_base
from cabflow.plans.pricing import pricing
from cabflow.plans.profile import staged_profile
from cabflow.plans.training import merged_order, training_table
from cabflow.schemas import ods_schema
from cabflow.session import scratch
from cabflow.sinks.writers import staged, write_overwrite, write_table
from cabflow.sources.tables import merged_path, read_days, read_ods

TABLES = (
    "service_order",
    "service_order_ext",
    "dispatch_info",
    "dispatch_detail",
    "pre_dispatch",
    "system_dispatch",
    "personal_dispatch",
)


#: What is counted on the way, in the order in which it is made.
COUNTED = ("orders", "dispatch", "candidates", "pricing", "merged")


@dataclass(frozen=True)
class Prepared:
    """Where a day's merged orders are, and how many rows each step had."""

    path: str
    rows: dict[str, int]


def ods_tables(
    spark: SparkSession, ods: str, dates: Sequence[str] | None, names: Sequence[str] = TABLES
) -> dict[str, DataFrame]:
    """Some days of the tables, in their declared columns; other days are not touched."""
    return {name: read_ods(spark, f"{ods}/{name}", dates, schema=ods_schema(name)) for name in names}


def _asked(info: DataFrame, dates: Sequence[str] | None) -> DataFrame:
    """Each pricing id that an order had in its rounds, written."""
    rounds = known(known(of_days(info, dates), "service_order_id"), "bidding_id")
    return staged(info.sparkSession, rounds.select("service_order_id", "bidding_id").distinct(), "asked")


def _needed(
    tables: dict[str, DataFrame], dates: Sequence[str] | None, city: str | None, tz: str
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """What can come into a merged order: the rows of the tables by order, the rounds by pricing
    id, and each pricing id that an order had.

    Many rounds and candidates may be of orders that were not finished or have no estimate, and
    most rows of an order are older states.  Which orders are kept is found first, from a few
    columns of the orders and their extensions; the tables are cut to them before they are parsed
    and shuffled, and all steps that follow are the same.
    """
    order, price = ["service_order_id"], ["bidding_id"]
    found = kept_orders(tables["service_order"], tables["service_order_ext"], dates, city, tz)
    found = staged(found.sparkSession, found, "kept")
    kept, last = KeyBits(found, order), [*order, "update_time"]
    needed = {n: kept.may_hold(tables[n], order) for n in ("service_order_ext", "dispatch_info", "dispatch_detail")}
    needed["service_order"] = KeyBits(found, last).may_hold(tables["service_order"], last)
    asked = _asked(needed["dispatch_info"], dates)
    # Who decided on a pricing id is said by all its rounds, whichever order they are of.
    priced = KeyBits(asked, price)
    needed |= {n: priced.may_hold(tables[n], price) for n in ("pre_dispatch", "system_dispatch", "personal_dispatch")}
    return needed, priced.may_hold(tables["dispatch_info"], price), asked


def merge_tables(
    tables: dict[str, DataFrame],
    dates: Sequence[str] | None = None,
    city: str | None = None,
    tz: str = LOCAL_ZONE,
    counts: RowCounts | None = None,
) -> DataFrame:
    """Merged orders as one plan; ``counts`` gets the rows of each step (:data:`COUNTED`).

    Without counts, rows that cannot come into a merged order are left out first.  With them the
    steps have all their rows.  A merge join stops reading its right side at the last row of its
    left one; so that no row is left out of the counts, what stands on the right is then written
    before it is joined.
    """
    if counts is None:
        watch = written = lambda _, df: df
        tables, priced, asked = _needed(tables, dates, city, tz)
    else:
        priced, asked = tables["dispatch_info"], _asked(tables["dispatch_info"], dates)
        watch = counts.watch
        written = lambda name, df: staged(df.sparkSession, watch(name, df), name)
    orders = order_base(tables["service_order"], tables["service_order_ext"], dates, city, tz)
    orders = watch("orders", orders)
    summary = watch("dispatch", dispatch_info_extract(tables["dispatch_info"], dates, city, tz))
    dispatch = dispatch_merged(
        summary, dispatch_candidates(tables["dispatch_detail"], dates, city, tz)
    )
    dispatch = written("candidates", dispatch)
    prices = pricing(
        tables["pre_dispatch"],
        tables["system_dispatch"],
        tables["personal_dispatch"],
        priced,
        dates,
        city,
        tz,
    )
    return watch("merged", merged_order(orders, dispatch, written("pricing", prices), asked))


def prepare_day(
    spark: SparkSession, ods: str, out: str, city: str, day: str, tz: str = LOCAL_ZONE
) -> Prepared:
    """Write the merged orders of one city and day; the rows of each step are counted by the way."""
    path, counts = merged_path(out, city, day), RowCounts()
    tables = ods_tables(spark, ods, [day])
    with scratch(spark):
        write_overwrite(merge_tables(tables, [day], city, tz, counts), path)
    return Prepared(path, counts.rows())


def build_training(
    spark: SparkSession,
    ods: str,
    merged: str,
    city: str,
    dates: Sequence[str],
    table: str,
    tz: str = LOCAL_ZONE,
    path: str | None = None,
) -> None:
    """Write the training table from merged days and the profiles over the same days."""
    tables = ods_tables(spark, ods, dates, ("dispatch_info", "dispatch_detail"))
    with scratch(spark):
        profile = staged_profile(
            spark, tables["dispatch_info"], tables["dispatch_detail"], dates, city, tz=tz
        )
        write_table(training_table(read_days(spark, merged, city, dates), profile), table, path=path)


def write_profile(
    spark: SparkSession,
    ods: str,
    city: str,
    dates: Sequence[str],
    table: str,
    path: str | None = None,
) -> None:
    """Write the profiles of one city's users."""
    tables = ods_tables(spark, ods, dates, ("dispatch_info", "dispatch_detail"))
    with scratch(spark):
        profile = staged_profile(
            spark, tables["dispatch_info"], tables["dispatch_detail"], dates, city
        )
        write_table(profile, table, fmt="parquet", path=path)
