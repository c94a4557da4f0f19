"""Dispatch rounds and candidate drivers, summarised per order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions.payloads import number
from cabflow.functions.times import LOCAL_ZONE, effective_time, to_epoch
from cabflow.operators.aggregates import SPREADS, batch_stats, round_total_columns
from cabflow.operators.filters import of_city, of_days
from cabflow.operators.joins import left_join
from cabflow.operators.numbering import hot_buckets, number_per_key
from cabflow.operators.picking import Snapshot, snapshots
from cabflow.operators.shaping import with_json

KEY = "service_order_id"

# JSON names of the price and template payloads, output name first.
PRICE_FIELDS = {
    "driver_bidding_rate": "dsb",
    "user_bidding_rate": "sb",
    "driver_estimate_price": "dep",
}
TEMPLATE_FIELDS = {"city": "city", "isRushHour": "isRushHour", "remark": "remark"}
PARAM_FIELDS = {
    "batch_driver_count": "bATCH_DRIVER_COUNT",
    "batch_interval": "bATCH_INTERVAL",
    "contribution_pct": "cONTRIBUTION",
    "distanct_pct": "dISTANCE",
    "evaluation_pct": "eVALUATION",
    "max_range": "mAX_RANGE",
}
RATES = tuple(PRICE_FIELDS)
# Those that no summary uses.
MORE_TEMPLATE_FIELDS = {"code": "code"}
MORE_PARAM_FIELDS = {
    "assign_max_range": "aSSIGN_MAX_RANGE",
    "max_accept_count": "mAX_ACCEPT_COUNT",
    "max_driver_count": "mAX_DRIVER_COUNT",
}

# The rest of a round's columns, in the order that tells tied rounds apart.
ROUND_COLUMNS = (
    "dispatch_time",
    "decision_time",
    "create_time",
    "update_time",
    "status",
    "bidding_id",
    "dispatch_type",
    "decision_type",
    "dispatch_count",
    "response_count",
    "accept_count",
    "flag",
    "user_level",
    "user_gender",
    "can_dispatch_count",
    "decision_driver_id",
    "decision_car_type_id",
)


POSITION = (KEY, "round", "batch", "datetime")


def dispatch_rounds(
    info: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    tz: str = LOCAL_ZONE,
    whole: bool = False,
) -> DataFrame:
    """Typed rounds; the city is the one in the template, not the one of the table.

    ``whole`` adds, at the end, the template's columns that the summaries do not use.
    """
    more_template, more_params = (MORE_TEMPLATE_FIELDS, MORE_PARAM_FIELDS) if whole else ({}, {})
    rows = of_days(info, dates).select(
        KEY,
        "round",
        "batch",
        to_epoch(F.col("datetime"), tz=tz).alias("datetime"),
        *ROUND_COLUMNS,
        "add_price_info",
        "template_snapshot",
    )
    template = TEMPLATE_FIELDS | more_template | {"_params": "dispatchParams"}
    rows = of_city(with_json(rows, F.col("template_snapshot"), template), city)
    rows = with_json(rows, F.col("_params"), PARAM_FIELDS | more_params)
    rows = with_json(rows, F.col("add_price_info"), {f"_{n}": f for n, f in PRICE_FIELDS.items()})
    return rows.select(
        *POSITION,
        *ROUND_COLUMNS,
        *[number(F.col(f"_{name}")).alias(name) for name in RATES],
        *TEMPLATE_FIELDS,
        *PARAM_FIELDS,
        *more_template,
        *more_params,
    )


def numbered_rounds(rounds: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """Running batch number per order; the whole row decides between equal positions.

    From ``info``, the log that the rounds are from, the rows of an order are counted without
    parsing its texts.
    """
    rest = [c for c in rounds.columns if c not in POSITION]
    return number_per_key(rounds, [KEY], POSITION[1:], "acc_batch", tiebreak=rest, counted=info)


def _prefixed(prefix: str, columns: Sequence[str]) -> dict[str, str]:
    return {f"{prefix}_{c}": c for c in columns}


def dispatch_summary(rounds: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """Last state, totals, first accept, first decision and end of each order's dispatch.

    All five come from one aggregate; ``sum_batch`` is the number of the batch that holds
    the last decision.
    """
    latest = Snapshot(
        {
            "city": "city",
            "bidding_id": "bidding_id",
            "sum_batch": "acc_batch",
            "dispatch_create_time": "create_time",
            "dispatch_status": "status",
            "dispatch_flag": "flag",
            "dispatch_type": "dispatch_type",
            "decision_type": "decision_type",
            "user_level": "user_level",
            "user_gender": "user_gender",
            "isRushHour": "isRushHour",
            "remark": "remark",
        }
        | {name: name for name in PARAM_FIELDS},
        ["decision_time"],
        newest=True,
    )
    first_accept = Snapshot(
        {
            "first_accept_round": "round",
            "first_accept_acc_batch": "acc_batch",
            "first_accept_time": "decision_time",
        }
        | _prefixed("first_accept", RATES),
        ["decision_time"],
        newest=False,
        where=F.col("accept_count") > 0,
    )
    first_decision = Snapshot(
        {
            "first_decision_round": "round",
            "first_decision_acc_batch": "acc_batch",
            "first_decision_time": "decision_time",
            "first_decision_driver_id": "decision_driver_id",
            "first_decision_car_type_id": "decision_car_type_id",
        }
        | _prefixed("first_decision", RATES),
        ["decision_time"],
        newest=False,
        where=F.col("decision_driver_id") > 0,
    )
    ended = effective_time(F.col("decision_time"), F.col("datetime"))
    final = Snapshot(
        {
            "final_round": "round",
            "final_decision_time": ended,
            "final_decision_driver_id": "decision_driver_id",
            "final_decision_car_type_id": "decision_car_type_id",
            "final_dispatch_status": "status",
        }
        | _prefixed("final", RATES),
        [ended],
        newest=True,
    )
    return snapshots(
        numbered_rounds(rounds, info),
        [KEY],
        [latest, first_accept, first_decision, final],
        totals=round_total_columns(),
        tiebreak=["acc_batch"],
    )


def dispatch_info_extract(
    info: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    tz: str = LOCAL_ZONE,
) -> DataFrame:
    return dispatch_summary(dispatch_rounds(info, dates, city, tz), of_days(info, dates))


# -- candidate drivers ---------------------------------------------------------

DETAIL_COLUMNS = (
    "driver_id",
    "dispatch_time",
    "response_time",
    "accept_status",
    "driver_bidding_rate",
    "driver_estimate_price",
    "decision_time",
    "decision_result",
    *SPREADS,
)


def dispatch_candidates(
    detail: DataFrame,
    dates: Sequence[str] | None = None,
    city: str | None = None,
    tz: str = LOCAL_ZONE,
) -> DataFrame:
    return of_city(of_days(detail, dates), city).select(
        KEY,
        "round",
        "batch",
        to_epoch(F.col("datetime"), tz=tz).alias("datetime"),
        *DETAIL_COLUMNS,
    )


#: With fewer candidates than this in a batch it takes less to shuffle them than their statistics.
FEW_CANDIDATES = 2


def _few_candidates(detail: DataFrame) -> bool:
    batch = F.xxhash64(KEY, "round", "batch")
    rows, batches = detail.agg(F.count(F.lit(1)), F.approx_count_distinct(batch)).first()
    return rows < FEW_CANDIDATES * batches


def numbered_batches(detail: DataFrame) -> DataFrame:
    """One row per batch with its running number.

    Batches of many candidates are put together in the tasks that read them, then by batch, then
    by order.  Where most have one or two, nothing is gained by that: the candidates are dealt by
    order once, unless an order is hot.
    """
    # An order has no more batches than rows.
    hot = hot_buckets(detail, [KEY])
    if hot.isEmpty() and _few_candidates(detail):
        detail = detail.repartition(KEY)
    numbered = number_per_key(batch_stats(detail), [KEY], ["round", "batch"], "acc_batch", hot=hot)
    return numbered.withColumn("acc_batch", F.col("acc_batch").cast("int"))


_MEASURES = (
    "min_bidding_rate",
    "max_bidding_rate",
    "min_price",
    "max_price",
    *[f"{kind}_{column}" for column in SPREADS for kind in ("min", "avg", "max")],
)


def _batch_snapshot(prefix: str, time: str, newest: bool, where=None, skip=()) -> Snapshot:
    columns = {
        f"{prefix}_round_ext": "round",
        f"{prefix}_acc_batch_ext": "acc_batch",
        f"{prefix}_time_ext": time,
    }
    measures = [m for m in _MEASURES if m not in skip]
    return Snapshot(columns | _prefixed(prefix, measures), [time], newest, where)


def batch_snapshots(batches: DataFrame) -> DataFrame:
    """First accepted, first decided and last batch of each order, from one aggregate."""
    specs = [
        _batch_snapshot(
            "first_accept",
            "response_time",
            newest=False,
            where=F.col("accept_count") > 0,
            skip=("avg_route_distance",),
        ),
        _batch_snapshot(
            "first_decision",
            "decision_time",
            newest=False,
            where=F.col("decision_complete") > 0,
        ),
        _batch_snapshot("final", "datetime", newest=True),
    ]
    return snapshots(batches, [KEY], specs, tiebreak=["acc_batch"])


def dispatch_merged(summary: DataFrame, candidates: DataFrame) -> DataFrame:
    """Order summaries with the batch snapshots of their candidate drivers."""
    return left_join(summary, batch_snapshots(numbered_batches(candidates)), KEY)
