"""The extracts, the merge, the training table, the profile and the KPIs (C4 to C11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions.times import day_bounds
from cabflow.operators.aggregates import SPREADS
from cabflow.operators.filters import of_days
from cabflow.plans.daily import build_training, merge_tables, prepare_day
from cabflow.plans.dispatch import (
    PARAM_FIELDS,
    RATES,
    ROUND_COLUMNS,
    dispatch_candidates,
    dispatch_info_extract,
    dispatch_merged,
    dispatch_rounds,
    numbered_rounds,
)
from cabflow.plans.kpi import refresh_dispatch_kpi
from cabflow.plans.orders import ORDER_COLUMNS, name_map, order_base
from cabflow.plans.pricing import pricing
from cabflow.plans.profile import staged_profile
from cabflow.plans.training import training_table
from cabflow.queries.base import Tables, query
from cabflow.queries.columns import ADJUST_SQL, GEO_KEY_SQL, LABEL_SQL, geohash_sql
from cabflow.queries.domain import (
    DATES,
    dispatch_detail,
    dispatch_info,
    tables,
    with_views,
    with_views_of,
)
from cabflow.queries.groups import (
    BATCH_SQL,
    KPI_SQL,
    PROFILE_MEANS,
    PROFILE_SQL,
    TOTALS_SQL,
    replace_rounded,
    rounded,
    small_ints,
)
from cabflow.schemas import LOGS, ods_schema
from cabflow.session import scratch_path
from cabflow.sinks.writers import staged_by, write_dealt

_SMALL = {"is_asap", "order_status", "rc_status"}


def _order_column(new: str, old: str) -> str:
    if new in _SMALL:
        return f"cast({old} as int) as {new}"
    if new == "coupon_facevalue":
        return f"cast({old} as double) as {new}"
    return f"{old} as {new}"


_ORDERS = f"""
    latest_order as (
        select {", ".join(_order_column(n, o) for n, o in name_map(ORDER_COLUMNS).items())}
        from (select *, row_number() over (partition by service_order_id
                  order by update_time desc) as rn
              from service_order
              where status in (7, 8) and create_time between {day_bounds(DATES[0])[0]}
                    and {day_bounds(DATES[-1])[1]}) ranked
        where rn = 1
    ),
    latest_ext as (
        select service_order_id, cast(user_type as int) as user_type,
               cast(predict_amount as double) as predict_amount, deadhead_distance,
               estimate_distance, estimate_price
        from (select *, row_number() over (partition by service_order_id
                  order by update_time desc, user_type desc, predict_amount desc,
                           deadhead_distance desc) as rn
              from service_order_ext) ranked
        where rn = 1
    ),
    orders_out as (
        select * from latest_order join latest_ext using (service_order_id)
        where estimate_distance is not null
    )
"""

_ROUND_ORDER = ["round", "batch", "datetime", *ROUND_COLUMNS, *RATES, "city", "isRushHour",
                "remark", *PARAM_FIELDS]


_SMALL_ROUND = ["round", "batch", "status", "dispatch_type", "decision_type", "user_level",
                "decision_car_type_id", "dispatch_count", "response_count", "accept_count",
                "can_dispatch_count"]


def _pick(name: str, source: str, order: str, where: str, columns: list[str]) -> str:
    return f"""
    {name} as (
        select service_order_id, {", ".join(columns)}
        from (select *, row_number() over (partition by service_order_id order by {order}) as rn
              from {source} where {where}) ranked
        where rn = 1
    )"""


def _rates(prefix: str) -> list[str]:
    return [f"cast({r} as double) as {prefix}_{r}" for r in RATES]


_ROUNDS = f"""
    numbered as (
        select *, cast(row_number() over (partition by service_order_id
                      order by {", ".join(f"{c} nulls first" for c in _ROUND_ORDER)}) as bigint)
                  as acc_batch,
               cast(case when decision_time > 0 then decision_time else datetime end as bigint)
                  as ended
        from dispatch_rounds
    ),
    {_pick("latest_round", "numbered", "decision_time desc nulls last, acc_batch desc", "true", [
        "city as dispatch_city", "bidding_id", "acc_batch as sum_batch",
        "create_time as dispatch_create_time", "cast(status as int) as dispatch_status",
        "flag as dispatch_flag", "cast(dispatch_type as int) as dispatch_type",
        "cast(decision_type as int) as decision_type", "cast(user_level as int) as user_level",
        "user_gender", "isRushHour", "remark", *PARAM_FIELDS])},
    {_pick("first_accept", "numbered", "decision_time nulls first, acc_batch", "accept_count > 0", [
        "cast(round as int) as first_accept_round", "acc_batch as first_accept_acc_batch",
        "decision_time as first_accept_time", *_rates("first_accept")])},
    {_pick("first_decision", "numbered", "decision_time nulls first, acc_batch",
           "decision_driver_id > 0", [
        "cast(round as int) as first_decision_round", "acc_batch as first_decision_acc_batch",
        "decision_time as first_decision_time",
        "decision_driver_id as first_decision_driver_id",
        "cast(decision_car_type_id as int) as first_decision_car_type_id",
        *_rates("first_decision")])},
    {_pick("final_round", "numbered", "ended desc nulls last, acc_batch desc", "true", [
        "cast(round as int) as final_round", "ended as final_decision_time",
        "decision_driver_id as final_decision_driver_id",
        "cast(decision_car_type_id as int) as final_decision_car_type_id",
        "cast(status as int) as final_dispatch_status", *_rates("final")])},
    round_totals as (
        select service_order_id, {TOTALS_SQL} from dispatch_rounds group by service_order_id
    ),
    info_out as (
        select * from latest_round
        left join round_totals using (service_order_id)
        left join first_accept using (service_order_id)
        left join first_decision using (service_order_id)
        left join final_round using (service_order_id)
    )
"""

_SPREAD_NAMES = [f"{kind}_{c}" for c in SPREADS for kind in ("min", "avg", "max")]


def _batch_columns(prefix: str, time: str, skip: str = "") -> list[str]:
    measures = ["min_bidding_rate", "max_bidding_rate", "min_price", "max_price", *_SPREAD_NAMES]
    return [
        f"round as {prefix}_round_ext",
        f"acc_batch as {prefix}_acc_batch_ext",
        f"{time} as {prefix}_time_ext",
        *[
            f"round({m}, 6) as {prefix}_{m}" if m.startswith("avg") else f"{m} as {prefix}_{m}"
            for m in measures
            if m != skip
        ],
    ]


_CANDIDATES = f"""
    grouped as ({BATCH_SQL}),
    batches as (
        select *, cast(row_number() over (partition by service_order_id order by round, batch)
                       as int) as acc_batch
        from grouped
    ),
    {_pick("accept_ext", "batches", "response_time nulls first, acc_batch", "accept_count > 0",
           _batch_columns("first_accept", "response_time", skip="avg_route_distance"))},
    {_pick("decision_ext", "batches", "decision_time nulls first, acc_batch",
           "decision_complete > 0", _batch_columns("first_decision", "decision_time"))},
    {_pick("final_ext", "batches", "datetime desc nulls last, acc_batch desc", "true",
           _batch_columns("final", "datetime"))},
    dispatch_out as (
        select * from info_out
        left join accept_ext using (service_order_id)
        left join decision_ext using (service_order_id)
        left join final_ext using (service_order_id)
    )
"""

_PRICES = """
    of_system as (select distinct bidding_id from dispatch_rounds where decision_type = 1),
    of_driver as (select distinct bidding_id from dispatch_rounds where decision_type = 2),
    system_last as (
        select bidding_id, round as end_bidding_round, cast(rate as double) as low,
               cast(rate as double) as high
        from (select *, row_number() over (partition by bidding_id
                  order by round desc, datetime desc, rate desc) as rn from system_dispatch
              where bidding_id in (select bidding_id from of_system)) r where rn = 1
    ),
    personal_last as (
        select bidding_id, round as end_bidding_round, cast(low as double) as low,
               cast(high as double) as high
        from (select *, row_number() over (partition by bidding_id
                  order by round desc, datetime desc, low desc) as rn from personal_dispatch
              where bidding_id in (select bidding_id from of_driver)) r where rn = 1
    ),
    prices_out as (
        select datetime, bidding_id, pre_productTypeId, pre_estimatePrice, pre_availableDriverNum,
               pre_M, end_bidding_round, low as end_min_bidding_rate, high as end_max_bidding_rate
        from (select * from pre_dispatch
              where bidding_id in (select bidding_id from dispatch_rounds)) pre
        left join (select * from system_last union all select * from personal_last) rates
            using (bidding_id)
    )
"""

_MERGED = """
    joined as (
        select orders_out.*, dispatch_out.* exclude (service_order_id, dispatch_city),
               prices_out.* exclude (bidding_id)
        from orders_out
        left join dispatch_out on dispatch_out.service_order_id = orders_out.service_order_id
        left join prices_out on prices_out.bidding_id = dispatch_out.bidding_id
    ),
    merged as (
        select *, case when (dispatch_flag & 1024) = 1024 then 'system_decision'
                       when (dispatch_flag & 512) = 512 then 'manual_decision'
                       else 'unkown' end as decision_type_flag
        from joined where not (final_max_bidding_rate > 0 and end_bidding_round is null)
    )
"""

_ORDER_VIEWS = with_views("service_order", "service_order_ext")
_INFO_VIEWS = with_views("dispatch_rounds")
_DISPATCH_VIEWS = with_views("dispatch_rounds", "dispatch_detail")
_PRICE_VIEWS = with_views("dispatch_rounds", "pre_dispatch", "system_dispatch", "personal_dispatch")
_ALL_VIEWS = with_views(
    "service_order",
    "service_order_ext",
    "dispatch_rounds",
    "dispatch_detail",
    "pre_dispatch",
    "system_dispatch",
    "personal_dispatch",
)
_STEPS = f"{_ORDERS}, {_ROUNDS}, {_CANDIDATES}, {_PRICES}, {_MERGED}"
_MERGE_STEPS = f"{_ALL_VIEWS}, {_STEPS}"

# One day of one city, as the daily jobs run.
_DAY, _CITY = DATES[2], "bj"
_DAY_VIEWS = with_views_of(
    _DAY,
    _CITY,
    "service_order",
    "service_order_ext",
    "dispatch_rounds",
    "dispatch_detail",
    "pre_dispatch",
    "system_dispatch",
    "personal_dispatch",
)


def _means(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "_avg_" in c and any(s in c for s in SPREADS)]


def _comparable(df: DataFrame) -> DataFrame:
    return rounded(small_ints(df), *_means(df))


@query("c4_order_extract", f"{_ORDER_VIEWS}, {_ORDERS} select * from orders_out")
def c4(t: Tables):
    all_tables = tables(t)
    return _comparable(
        order_base(all_tables["service_order"], all_tables["service_order_ext"], DATES)
    )


_WHOLE_ROUND = [*_ROUND_ORDER, "code", "assign_max_range", "max_accept_count", "max_driver_count"]


@query(
    "p2_round_columns",
    f"""
    {_INFO_VIEWS}
    select service_order_id, {", ".join(c for c in _WHOLE_ROUND if c not in (*RATES, *_SMALL_ROUND))},
           {", ".join(f"cast({c} as double) as {c}" for c in RATES)},
           {", ".join(f"cast({c} as int) as {c}" for c in _SMALL_ROUND)},
           cast(row_number() over (partition by service_order_id
                order by {", ".join(f"{c} nulls first" for c in _WHOLE_ROUND)}) as bigint) as acc_batch
    from dispatch_rounds
    """,
)
def p2_rounds(t: Tables):
    """All columns of a round with its running number."""
    info = dispatch_info(t)
    return small_ints(numbered_rounds(dispatch_rounds(info, DATES, whole=True), of_days(info, DATES)))


@query("c5_dispatch_rounds", f"{_INFO_VIEWS}, {_ROUNDS} select * from info_out")
def c5(t: Tables):
    extract = dispatch_info_extract(dispatch_info(t), DATES)
    return _comparable(extract.withColumnRenamed("city", "dispatch_city"))


@query(
    "c6_dispatch_candidates",
    f"{_DISPATCH_VIEWS}, {_ROUNDS}, {_CANDIDATES} select * from dispatch_out",
)
def c6(t: Tables):
    summary = dispatch_info_extract(dispatch_info(t), DATES)
    merged = dispatch_merged(summary, dispatch_candidates(dispatch_detail(t), DATES))
    return _comparable(merged.withColumnRenamed("city", "dispatch_city"))


@query("c7_pricing", f"{_PRICE_VIEWS}, {_PRICES} select * from prices_out")
def c7(t: Tables):
    all_tables = tables(t)
    return pricing(
        all_tables["pre_dispatch"],
        all_tables["system_dispatch"],
        all_tables["personal_dispatch"],
        all_tables["dispatch_info"],
        DATES,
    )


@query("c8_merged_order", f"{_MERGE_STEPS} select * from merged")
def c8(t: Tables):
    return _comparable(merge_tables(tables(t), DATES))


def _ods(t: Tables) -> str:
    """All days of the seven tables as folders, in their declared columns."""
    ods = scratch_path(t.spark, "ods")
    for name, rows in tables(t).items():
        declared = t.spark.createDataFrame([], ods_schema(name)).schema
        typed = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared
        ]
        by = ["dt", "hour"] if LOGS[name].by_hour else ["dt"]
        write_dealt(rows.select(*typed), f"{ods}/{name}", by)
    return ods


def _as_planned(df: DataFrame, t: Tables) -> DataFrame:
    """The declared columns are narrower than those that the checks derive."""
    # Only the types: none of the rows.
    like = merge_tables({name: rows.limit(0) for name, rows in tables(t).items()}, DATES)
    kinds = {f.name: f.dataType for f in like.schema}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


@query("c8_prepare_day", f"{_DAY_VIEWS}, {_STEPS} select * from merged")
def c8_day(t: Tables):
    """The daily job from table folders to the merged orders of one city."""
    done = prepare_day(t.spark, _ods(t), scratch_path(t.spark, "merged"), _CITY, _DAY)
    return _comparable(_as_planned(t.spark.read.parquet(done.path), t))


@query(
    "a11_step_rows",
    f"""
    {_DAY_VIEWS}, {_STEPS}
    select 'orders' as step, (select count(*) from orders_out) as rows
    union all select 'dispatch', (select count(*) from info_out)
    union all select 'candidates', (select count(*) from dispatch_out)
    union all select 'pricing', (select count(*) from prices_out)
    union all select 'merged', (select count(*) from merged)
    """,
)
def a11_steps(t: Tables):
    """What the daily job says about its steps."""
    done = prepare_day(t.spark, _ods(t), scratch_path(t.spark, "merged"), _CITY, _DAY)
    return t.spark.createDataFrame(list(done.rows.items()), "step string, rows bigint")


_TRAINING = f"""
    placed as (
        select *, {GEO_KEY_SQL} as cell,
               {geohash_sql("expect_start_latitude", "expect_start_longitude")} as expect_geohash,
               case when final_driver_bidding_rate > 0 or final_max_bidding_rate > 0
                    then 1 else 0 end as is_surcharged,
               case when final_decision_driver_id > 0 and final_driver_bidding_rate > 0
                    then 1 else 0 end as is_accepted
        from merged
    ),
    demand as (
        select cell, count(*) as abs_demand,
               avg(pre_availableDriverNum) / (count(*) + 1) as relative_supply
        from placed group by cell
    ),
    geo as (
        select expect_geohash, count(*) as geo_order_count,
               cast(sum(is_surcharged) as bigint) as geo_bidding_count,
               cast(sum(is_accepted) as bigint) as geo_bidding_ok_count,
               round(coalesce(sum(is_surcharged) / nullif(count(*), 0), -1e0), 6)
                   as geo_bidding_pct,
               round(coalesce(sum(is_accepted) / nullif(sum(is_surcharged), 0), -1e0), 6)
                   as geo_bidding_ok_pct
        from placed group by expect_geohash
    ),
    training as (
        select placed.* exclude (cell, is_surcharged, is_accepted), abs_demand,
               round(relative_supply, 6) as relative_supply,
               profile.* exclude (uid), geo.* exclude (expect_geohash),
               {ADJUST_SQL.format(driver="final_decision_driver_id",
                                  rate="final_driver_bidding_rate",
                                  max="final_max_bidding_rate", end="end_max_bidding_rate")}
                   as bidding_rate_adjust,
               {LABEL_SQL.format(driver="final_decision_driver_id",
                                 rate="final_driver_bidding_rate", end="end_max_bidding_rate")}
                   as label
        from placed
        left join demand on demand.cell = placed.cell
        left join (select {replace_rounded(PROFILE_MEANS)} from profile) profile
            on profile.uid = placed.user_id
        left join geo on geo.expect_geohash = placed.expect_geohash
        where avg_can_dispatch >= 0 and abs_demand >= 0 and relative_supply >= 0
    )
"""


def _profile_after_views() -> str:
    """The steps of the profile, without the views it starts with."""
    return PROFILE_SQL.strip().removeprefix(_DISPATCH_VIEWS.strip())


@query(
    "c9_training_table",
    f"{_MERGE_STEPS}{_profile_after_views()}, {_TRAINING} select * from training",
)
def c9(t: Tables):
    all_tables = tables(t)
    merged = staged_by(t.spark, merge_tables(all_tables, DATES), "merged", "service_order_id")
    profile = staged_profile(
        t.spark, all_tables["dispatch_info"], all_tables["dispatch_detail"], DATES
    )
    table = _comparable(training_table(merged, profile))
    return rounded(
        table, "relative_supply", "geo_bidding_pct", "geo_bidding_ok_pct", *PROFILE_MEANS
    )


@query(
    "c9_training_of_city",
    f"{_DAY_VIEWS}, {_STEPS}{_profile_after_views()}, {_TRAINING} select * from training",
)
def c9_city(t: Tables):
    """The jobs of one city, from table folders to the written training table."""
    ods, merged, path = _ods(t), scratch_path(t.spark, "merged"), scratch_path(t.spark, "training")
    prepare_day(t.spark, ods, merged, _CITY, _DAY)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    build_training(t.spark, ods, merged, _CITY, [_DAY], name, path=path)
    table = _comparable(_as_planned(t.spark.table(name), t))
    return rounded(
        table, "relative_supply", "geo_bidding_pct", "geo_bidding_ok_pct", *PROFILE_MEANS
    )


@query("c10_user_profile", f"{PROFILE_SQL} select {replace_rounded(PROFILE_MEANS)} from profile")
def c10(t: Tables):
    profile = staged_profile(t.spark, dispatch_info(t), dispatch_detail(t), DATES)
    return rounded(profile, *PROFILE_MEANS)


@query("c11_dispatch_kpi", KPI_SQL)
def c11(t: Tables):
    """The job, run twice on one table."""
    path = scratch_path(t.spark, "kpi")
    for _ in range(2):
        refresh_dispatch_kpi(t.spark, dispatch_info(t), path)
    return t.spark.read.parquet(path).select("key", "value", "datetime")
