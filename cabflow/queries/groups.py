"""Joins and aggregates (J, A)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions.geo import geo_time_key
from cabflow.operators import aggregates
from cabflow.operators.joins import left_join, semi, upsert, with_group_stats
from cabflow.operators.picking import Snapshot, snapshots
from cabflow.plans.dispatch import dispatch_candidates
from cabflow.plans.profile import profile_base
from cabflow.plans.training import demand_of, with_cells, with_demand_of_order
from cabflow.queries.base import Tables, query
from cabflow.queries.columns import ACCEPT_SQL, GEO_KEY_SQL, geohash_sql
from cabflow.queries.domain import (
    DATES,
    dispatch_detail,
    dispatch_info,
    pre_dispatch,
    service_order,
    with_views,
)
from cabflow.session import scratch_path
from cabflow.sinks.writers import staged, write_dealt
from cabflow.streaming.cells import SLOT_COLUMNS, accounts, start_supply_demand


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Means are summed in no fixed order, so their last digits are not compared."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# -- joins -----------------------------------------------------------------------------


@query(
    "j1_left",
    """
    select o_orderkey, o_custkey, c_name, c_nationkey
    from orders left join customer on c_custkey = o_custkey
    """,
)
def j1(t: Tables):
    customers = t.customer.select("c_custkey", "c_name", "c_nationkey")
    return left_join(t.orders.select("o_orderkey", "o_custkey"), customers, "o_custkey", "c_custkey")


_PICK_SQL = """
    select {cols} from (select *, row_number() over (partition by l_orderkey
        order by {order}) as rn from lineitem where {where}) r where rn = 1
"""


@query(
    "j2_snapshots",
    f"""
    with latest as ({_PICK_SQL.format(
        cols="l_orderkey, l_linenumber as last_round, l_suppkey as last_driver", where="true",
        order="l_shipdate desc, l_partkey desc, l_suppkey desc, l_linenumber desc")}),
    accepted as ({_PICK_SQL.format(
        cols="l_orderkey, l_linenumber as accept_round, l_discount as accept_rate",
        where="l_returnflag = 'A'",
        order="l_shipdate, l_partkey, l_suppkey, l_linenumber")}),
    totals as (select l_orderkey, max(l_linenumber) as max_round,
                      cast(sum(l_linenumber) as bigint) as sum_round
               from lineitem group by l_orderkey)
    select l_orderkey, last_round, last_driver, accept_round, accept_rate, max_round, sum_round
    from latest left join accepted using (l_orderkey) left join totals using (l_orderkey)
    """,
)
def j2(t: Tables):
    time = ["l_shipdate"]
    return snapshots(
        t.lineitem,
        ["l_orderkey"],
        [
            Snapshot({"last_round": "l_linenumber", "last_driver": "l_suppkey"}, time, True),
            Snapshot(
                {"accept_round": "l_linenumber", "accept_rate": "l_discount"},
                time,
                False,
                F.col("l_returnflag") == "A",
            ),
        ],
        totals=[
            F.max("l_linenumber").alias("max_round"),
            F.sum("l_linenumber").alias("sum_round"),
        ],
        tiebreak=["l_partkey", "l_suppkey", "l_linenumber"],
    )


@query(
    "j3_summary_and_batches",
    """
    with info as (select l_orderkey, max(l_linenumber) as max_round from lineitem group by 1),
    batches as (select l_orderkey, l_linenumber, max(l_discount) as rate
                from lineitem where l_returnflag = 'R' group by 1, 2),
    last as (select l_orderkey, l_linenumber as last_batch, rate from (
        select *, row_number() over (partition by l_orderkey order by l_linenumber desc) as rn
        from batches) r where rn = 1)
    select l_orderkey, max_round, last_batch, rate from info left join last using (l_orderkey)
    """,
)
def j3(t: Tables):
    info = t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("max_round"))
    batches = (
        t.lineitem.where("l_returnflag = 'R'")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(F.max("l_discount").alias("rate"))
    )
    last = Snapshot({"last_batch": "l_linenumber", "rate": "rate"}, ["l_linenumber"], True)
    return left_join(info, snapshots(batches, ["l_orderkey"], [last]), "l_orderkey")


@query(
    "j4_fan_out",
    """
    select o_orderkey, rate, source from orders left join (
        select l_orderkey, max(l_discount) as rate, 'system' as source
        from lineitem where l_returnflag = 'A' group by 1
        union all
        select l_orderkey, max(l_tax), 'personal'
        from lineitem where l_returnflag = 'R' group by 1
    ) rates on l_orderkey = o_orderkey
    """,
)
def j4(t: Tables):
    def side(flag: str, column: str, source: str) -> DataFrame:
        lines = t.lineitem.where(F.col("l_returnflag") == flag)
        grouped = lines.groupBy("l_orderkey").agg(F.max(column).alias("rate"))
        return grouped.withColumn("source", F.lit(source))

    rates = side("A", "l_discount", "system").unionByName(side("R", "l_tax", "personal"))
    return left_join(t.orders.select("o_orderkey"), rates, "o_orderkey", "l_orderkey")


@query(
    "j5_three_way",
    """
    select o_orderkey, pricing_id, max_round, c_nationkey
    from (select o_orderkey, case when o_orderstatus = 'F' then null else o_custkey end
                 as pricing_id from orders) o
    left join (select l_orderkey, max(l_linenumber) as max_round from lineitem group by 1) d
      on l_orderkey = o_orderkey
    left join customer on c_custkey = pricing_id
    """,
)
def j5(t: Tables):
    """Orders of one status have no pricing id, which is a large part of the table."""
    pricing_id = F.when(F.col("o_orderstatus") == "F", None).otherwise(F.col("o_custkey"))
    orders = t.orders.select("o_orderkey", pricing_id.alias("pricing_id"))
    rounds = t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("max_round"))
    joined = left_join(orders, rounds, "o_orderkey", "l_orderkey")
    customers = t.customer.select("c_custkey", "c_nationkey")
    return left_join(joined, customers, "pricing_id", "c_custkey", often_missing=True)


_PLACED_SQL = f"""
    select o_orderkey, {GEO_KEY_SQL} as cell, o_custkey % 40 as available
    from (select o_orderkey, o_custkey, create_time as order_create_time,
                 expect_start_latitude, expect_start_longitude
          from orders join (select distinct service_order_id, create_time, expect_start_latitude,
                            expect_start_longitude from service_order) s
          on service_order_id = o_orderkey) placed
"""


@query(
    "j6_group_back",
    f"""
    {with_views("service_order")}
    , placed as ({_PLACED_SQL})
    select o_orderkey, cell, abs_demand, round(relative_supply, 6) as relative_supply
    from placed left join (select cell, count(*) as abs_demand,
                                  avg(available) / (count(*) + 1) as relative_supply
                           from placed group by cell) grouped using (cell)
    """,
)
def j6(t: Tables):
    key = geo_time_key(
        F.col("create_time"), F.col("expect_start_latitude"), F.col("expect_start_longitude")
    )
    # The two versions of an order are in the same place.
    placed = (
        service_order(t)
        .select(
            F.col("service_order_id").alias("o_orderkey"),
            key.alias("cell"),
            F.expr("user_id % 40").alias("pre_availableDriverNum"),
        )
        .distinct()
    )
    stats = with_group_stats(placed, "cell", aggregates.supply_demand_columns())
    return rounded(stats.drop("pre_availableDriverNum"), "relative_supply")


_ENDED = "cast(case when decision_time > 0 then decision_time else datetime end as bigint)"
_LAST_ROUND = f"""
    last_round as (
        select service_order_id, final_decision_time, user_id,
               decision_driver_id as final_decision_driver_id,
               driver_bidding_rate as final_driver_bidding_rate
        from (select *, row_number() over (partition by service_order_id
                  order by final_decision_time desc, user_id desc, decision_driver_id desc,
                           driver_bidding_rate desc) as rn
              from (select *, {_ENDED} as final_decision_time from dispatch_rounds) timed) ranked
        where rn = 1
    ),
    extremes as (
        select service_order_id, max(driver_bidding_rate) as final_max_bidding_rate,
               min(dispatch_time) as min_dispatch_time
        from dispatch_detail group by service_order_id
    ),
    profile_base as (
        select * from last_round left join extremes using (service_order_id)
    )
"""
_FLAGGED = """
    flagged as (
        select *, final_decision_time - min_dispatch_time as wait,
               case when final_decision_driver_id > 0 then 1 else 0 end as decided,
               case when final_driver_bidding_rate > 0 or final_max_bidding_rate > 0
                    then 1 else 0 end as surcharged,
               case when final_decision_driver_id > 0 and final_driver_bidding_rate > 0
                    then 1 else 0 end as accepted
        from profile_base
    )
"""
_TOTALS = f"""
    totals as (
        select user_id, count(*) as user_order_count,
               avg(wait) as user_mean_wait_time,
               cast(sum(decided) as bigint) as user_order_decision_ok_count,
               cast(sum(surcharged) as bigint) as user_bidding_count,
               cast(sum(accepted) as bigint) as user_bidding_ok_count,
               coalesce(sum(accepted) / nullif(sum(surcharged), 0), -1e0)
                   as user_bidding_accept_pct,
               {ACCEPT_SQL.format(n="sum(surcharged)", ok="sum(accepted)")}
                   as user_bidding_accept_flag
        from flagged group by user_id
    )
"""
_RATES = """
    rates as (
        select user_id, avg(cast(rate as double)) as user_accept_avg_bidding_rate,
               cast(quantile_disc(rate, 0.25) as double) as user_accept_25pct_bidding_rate,
               cast(quantile_disc(rate, 0.5) as double) as user_accept_50pct_bidding_rate,
               cast(quantile_disc(rate, 0.75) as double) as user_accept_75pct_bidding_rate
        from (select user_id, cast(final_driver_bidding_rate as float) as rate
              from flagged where accepted = 1) ok
        group by user_id
    )
"""
_RECENT = """
    recent as (
        select user_id, avg(wait) as user_mean_wait_time_topk
        from (select *, row_number() over (partition by user_id
                  order by final_decision_time desc nulls last, service_order_id desc) as rn
              from flagged) ranked
        where rn <= 2 group by user_id
    )
"""
PROFILE_SQL = f"""
    {with_views("dispatch_rounds", "dispatch_detail")},
    {_LAST_ROUND}, {_FLAGGED}, {_TOTALS}, {_RATES}, {_RECENT},
    profile as (
        select totals.user_id as uid, user_order_count, user_order_decision_ok_count,
               user_order_decision_ok_count / user_order_count as order_decision_ok_pct,
               user_mean_wait_time, user_mean_wait_time_topk, user_bidding_count,
               user_bidding_ok_count, user_bidding_accept_flag, user_bidding_accept_pct,
               coalesce(user_accept_avg_bidding_rate, -1e0) as user_accept_avg_bidding_rate,
               coalesce(user_accept_25pct_bidding_rate, -1e0) as user_accept_25pct_bidding_rate,
               coalesce(user_accept_50pct_bidding_rate, -1e0) as user_accept_50pct_bidding_rate,
               coalesce(user_accept_75pct_bidding_rate, -1e0) as user_accept_75pct_bidding_rate
        from totals left join rates on rates.user_id = totals.user_id
        left join recent on recent.user_id = totals.user_id
    )
"""
PROFILE_MEANS = [
    "order_decision_ok_pct",
    "user_mean_wait_time",
    "user_mean_wait_time_topk",
    "user_bidding_accept_pct",
    "user_accept_avg_bidding_rate",
]


def replace_rounded(columns: list[str]) -> str:
    listed = ", ".join(f"round({c}, 6) as {c}" for c in columns)
    return f"* replace ({listed})"


@query("j7_user_profile", f"{PROFILE_SQL} select {replace_rounded(PROFILE_MEANS)} from profile")
def j7(t: Tables):
    base = profile_base(dispatch_info(t), dispatch_detail(t))
    return rounded(aggregates.user_profile(base), *PROFILE_MEANS)


@query(
    "j8_semi",
    """
    select c_custkey, c_name from customer
    where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')
    """,
)
def j8(t: Tables):
    keys = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return semi(t.customer.select("c_custkey", "c_name"), keys, ["c_custkey"])


@query(
    "j9_upsert",
    """
    with new as (select s_suppkey as key, s_name as name from supplier)
    select c_custkey as key, c_name as name from customer
    where c_custkey not in (select key from new)
    union all select key, name from new
    """,
)
def j9(t: Tables):
    old = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    new = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return upsert(old, new, ["key"])


@query(
    "j10_three_left_joins",
    """
    select o_orderkey, l_rows, c_nationkey, n_name
    from orders
    left join (select l_orderkey, count(*) as l_rows from lineitem group by 1) l
      on l_orderkey = o_orderkey
    left join customer on c_custkey = o_custkey
    left join nation on n_nationkey = c_nationkey
    """,
)
def j10(t: Tables):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("l_rows"))
    rows = left_join(t.orders.select("o_orderkey", "o_custkey"), lines, "o_orderkey", "l_orderkey")
    customers = t.customer.select("c_custkey", "c_nationkey")
    rows = left_join(rows, customers, "o_custkey", "c_custkey", often_missing=True)
    nations = t.nation.select("n_nationkey", "n_name")
    return left_join(rows, nations, "c_nationkey", "n_nationkey", often_missing=True).drop(
        "o_custkey"
    )


_BASE_COLUMNS = (
    "service_order_id, final_decision_time, user_id, final_decision_driver_id,"
    " final_driver_bidding_rate, final_max_bidding_rate, min_dispatch_time"
)


@query(
    "j11_profile_base",
    f"""
    {with_views("dispatch_rounds", "dispatch_detail")}, {_LAST_ROUND}
    select {_BASE_COLUMNS} from profile_base
    """,
)
def j11(t: Tables):
    return profile_base(dispatch_info(t), dispatch_detail(t))


# -- aggregates ------------------------------------------------------------------------

TOTALS_SQL = """
    cast(max(round) as int) as max_round,
    round(avg(can_dispatch_count), 0) as avg_can_dispatch,
    cast(sum(can_dispatch_count) as bigint) as sum_can_dispatch,
    round(avg(dispatch_count), 0) as avg_dispatch_count,
    cast(sum(dispatch_count) as bigint) as sum_dispatch,
    round(avg(response_count), 0) as avg_response_count,
    cast(sum(response_count) as bigint) as sum_response,
    cast(sum(accept_count) as bigint) as sum_accept
"""


@query(
    "a1_totals",
    f"""
    {with_views("dispatch_rounds")}
    select service_order_id, {TOTALS_SQL} from dispatch_rounds group by service_order_id
    """,
)
def a1(t: Tables):
    totals = aggregates.round_totals(dispatch_info(t))
    return totals.withColumn("max_round", F.col("max_round").cast("int"))


SPREAD_SQL = ", ".join(
    f"min({c}) as min_{c}, avg({c}) as avg_{c}, max({c}) as max_{c}" for c in aggregates.SPREADS
)
BATCH_SQL = f"""
    select service_order_id, cast(round as int) as round, cast(batch as int) as batch,
           max(datetime) as datetime, count(driver_id) as dispatch_count,
           max(dispatch_time) as dispatch_time,
           cast(sum(case when accept_status = 1 then 1 else 0 end) as bigint) as accept_count,
           max(response_time) as response_time,
           max(case when decision_result = 2 then 1 else 0 end) as decision_complete,
           max(decision_time) as decision_time,
           min(driver_bidding_rate) as min_bidding_rate,
           max(driver_bidding_rate) as max_bidding_rate,
           min(driver_estimate_price) as min_price, max(driver_estimate_price) as max_price,
           {SPREAD_SQL}
    from dispatch_detail group by service_order_id, round, batch
"""
SPREAD_MEANS = [f"avg_{c}" for c in aggregates.SPREADS]


def small_ints(df: DataFrame) -> DataFrame:
    """One- and two-byte numbers as int, decimals as double, as the checks give them."""
    kinds = {"tinyint": "int", "smallint": "int"}

    def kind(data_type: str) -> str | None:
        return "double" if data_type.startswith("decimal") else kinds.get(data_type)

    casts = {c: kind(d) for c, d in df.dtypes if kind(d)}
    return df.withColumns({c: F.col(c).cast(d) for c, d in casts.items()})


@query(
    "a2_batch_stats",
    f"""
    {with_views("dispatch_detail")}, batches as ({BATCH_SQL})
    select {replace_rounded(SPREAD_MEANS)} from batches
    """,
)
def a2(t: Tables):
    stats = aggregates.batch_stats(dispatch_candidates(dispatch_detail(t)))
    return rounded(small_ints(stats), *SPREAD_MEANS)


@query(
    "a3_extremes",
    f"""
    {with_views("dispatch_detail")}
    select service_order_id, max(driver_bidding_rate) as final_max_bidding_rate,
           min(dispatch_time) as min_dispatch_time
    from dispatch_detail group by service_order_id
    """,
)
def a3(t: Tables):
    return aggregates.order_extremes(dispatch_detail(t))


_BASE = f"""{with_views("dispatch_rounds", "dispatch_detail")}, {_LAST_ROUND}, {_FLAGGED}"""


@query(
    "a4_user_totals",
    f"""
    {_BASE}, {_TOTALS}
    select {replace_rounded(["user_mean_wait_time", "user_bidding_accept_pct"])} from totals
    """,
)
def a4(t: Tables):
    totals = aggregates.user_totals(profile_base(dispatch_info(t), dispatch_detail(t)))
    return rounded(totals, "user_mean_wait_time", "user_bidding_accept_pct")


@query(
    "a5_quantiles",
    f"""
    {_BASE}, {_RATES} select {replace_rounded(["user_accept_avg_bidding_rate"])} from rates
    """,
)
def a5(t: Tables):
    rates = aggregates.rate_quantiles(profile_base(dispatch_info(t), dispatch_detail(t)))
    return rounded(rates, "user_accept_avg_bidding_rate")


@query(
    "a6_recent_wait",
    f"""
    {_BASE}, {_RECENT} select {replace_rounded(["user_mean_wait_time_topk"])} from recent
    """,
)
def a6(t: Tables):
    recent = aggregates.recent_wait(profile_base(dispatch_info(t), dispatch_detail(t)))
    return rounded(recent, "user_mean_wait_time_topk")


@query(
    "a6_recent_wait_literal",
    f"""
    {_BASE}
    select user_id, round(avg(wait), 6) as user_mean_wait_time_topk from flagged group by user_id
    """,
)
def a6_literal(t: Tables):
    base = profile_base(dispatch_info(t), dispatch_detail(t))
    return rounded(aggregates.recent_wait(base, by="order"), "user_mean_wait_time_topk")


def _available(t: Tables) -> DataFrame:
    prices = pre_dispatch(t).select(
        "bidding_id",
        F.expr("cast(bidding_id % 40 as double)").alias("pre_availableDriverNum"),
    )
    orders = service_order(t).withColumnRenamed("create_time", "order_create_time")
    return left_join(orders, prices, "service_order_id", "bidding_id")


@query(
    "a7_supply_demand",
    f"""
    {with_views("service_order")}
    select {GEO_KEY_SQL} as geo_time_key, count(*) as abs_demand,
           round(avg(service_order_id % 40) / (count(*) + 1), 6) as relative_supply
    from (select *, create_time as order_create_time from service_order) placed group by 1
    """,
)
def a7(t: Tables):
    return rounded(aggregates.supply_demand(_available(t)), "relative_supply")


def _with_outcomes(t: Tables) -> DataFrame:
    outcomes = profile_base(dispatch_info(t), dispatch_detail(t)).drop("user_id")
    return left_join(service_order(t), outcomes, "service_order_id")


@query(
    "a8_geo_stats",
    f"""
    {with_views("service_order", "dispatch_rounds", "dispatch_detail")}, {_LAST_ROUND},
    placed as (
        select {geohash_sql("expect_start_latitude", "expect_start_longitude")} as geo,
               case when final_driver_bidding_rate > 0 or final_max_bidding_rate > 0
                    then 1 else 0 end as surcharged,
               case when final_decision_driver_id > 0 and final_driver_bidding_rate > 0
                    then 1 else 0 end as accepted
        from service_order left join profile_base using (service_order_id)
    )
    select geo, count(*) as geo_order_count,
           cast(sum(surcharged) as bigint) as geo_bidding_count,
           cast(sum(accepted) as bigint) as geo_bidding_ok_count,
           round(coalesce(sum(surcharged) / nullif(count(*), 0), -1e0), 6) as geo_bidding_pct,
           round(coalesce(sum(accepted) / nullif(sum(surcharged), 0), -1e0), 6)
               as geo_bidding_ok_pct
    from placed group by geo
    """,
)
def a8(t: Tables):
    stats = aggregates.geo_stats(_with_outcomes(t))
    return rounded(stats, "geo_bidding_pct", "geo_bidding_ok_pct")


@query(
    "a9_distinct",
    f"""
    {with_views("dispatch_rounds")}
    select count(distinct service_order_id) as orders from dispatch_rounds
    where decision_driver_id > 0
    """,
)
def a9(t: Tables):
    return aggregates.distinct_orders(dispatch_info(t), F.col("decision_driver_id") > 0)


KPI_SQL = f"""
    {with_views("dispatch_rounds")},
    counts as (
        select count(distinct service_order_id) as total,
               count(distinct case when decision_driver_id > 0 then service_order_id end) as succ
        from dispatch_rounds where bidding_id > 0
    )
    select 'dispatch_succ_rate' as key, printf('%.4f', round(succ / total, 4)) as value,
           '0' as datetime from counts
    union all select 'dispatch_count_succ', printf('%.4f', cast(succ as double)), '0' from counts
    union all select 'dispatch_count_all', printf('%.4f', cast(total as double)), '0' from counts
"""


@query("a10_kpi", KPI_SQL)
def a10(t: Tables):
    return aggregates.kpi_rows(dispatch_info(t))


@query("a11_observed", "select o_orderkey, o_orderstatus, (select count(*) from orders) as rows from orders")
def a11(t: Tables):
    """All rows, written once, with the count that the write gave by the way."""
    rows, found = aggregates.observed(t.orders.select("o_orderkey", "o_orderstatus"), "orders")
    written = staged(t.spark, rows, "observed")
    return written.withColumn("rows", F.lit(found.get["rows"]).cast("bigint"))


@query(
    "j6_demand_of_order",
    f"""
    {with_views("service_order")},
    placed as (
        select service_order_id, update_time, {GEO_KEY_SQL} as cell
        from (select *, create_time as order_create_time from service_order) o
    ), demand as (
        select cell, count(*) as abs_demand,
               round(avg(service_order_id % 40) / (count(*) + 1), 6) as relative_supply
        from placed group by cell
    )
    select a.service_order_id, a.update_time, abs_demand, relative_supply
    from placed a join placed b on b.service_order_id = a.service_order_id
    join demand on demand.cell = b.cell
    """,
)
def j6_by_order(t: Tables):
    """Joined by the order, two versions of an order are four rows."""
    orders = _available(t)
    joined = with_demand_of_order(with_cells(orders), demand_of(orders))
    return rounded(joined.select("service_order_id", "update_time", "abs_demand", "relative_supply"), "relative_supply")


_STREAM_DELAY = 600


@query(
    "a7_supply_demand_stream",
    f"""
    {with_views("service_order")},
    placed as (
        select {GEO_KEY_SQL} as geo_time_key, order_create_time // 300 * 300 + 300 as slot_end,
               service_order_id, order_create_time,
               service_order_id % 50 = 0 and dt = {DATES[0]} as late
        from (select *, create_time as order_create_time from service_order) o
    )
    select geo_time_key, count(*) as abs_demand,
           round(avg(service_order_id % 40) / (count(*) + 1), 6) as relative_supply,
           (select count(*) from placed where late) as late_orders
    from placed
    where not late
      and slot_end <= (select max(order_create_time) - {_STREAM_DELAY} from placed where not late)
    group by geo_time_key
    """,
)
def a7_stream(t: Tables):
    """Days come one after the other; some orders of the first day come after all others, when
    their windows are closed.  The stream is stopped in between and goes on."""
    source, out, checkpoint = (scratch_path(t.spark, n) for n in ("orders", "slots", "state"))
    columns = ["order_create_time", "expect_start_latitude", "expect_start_longitude", "pre_availableDriverNum"]
    late = F.expr(f"service_order_id % 50 = 0 and dt = {DATES[0]}")
    turns = [(F.col("dt").isin(*map(int, days)), n) for n, days in enumerate((DATES[:3], DATES[3:5], DATES[5:]))]
    turn = F.when(late, len(turns))
    for of_turn, n in turns:
        turn = turn.when(~late & of_turn, n)
    # Written once, by turn; rows of other days have none and are left out.
    orders = _available(t).withColumn("_turn", turn).where("_turn is not null").select(*columns, "_turn")
    dealt = scratch_path(t.spark, "turns")
    write_dealt(orders, dealt, ["_turn"])
    dealt = t.spark.read.schema(orders.schema).parquet(dealt)
    for n in range(len(turns) + 1):
        part = dealt.where(F.col("_turn") == n).select(*columns)
        part.write.mode("append").parquet(source)
        replayed = t.spark.readStream.schema(part.schema).parquet(source)
        delay = f"{_STREAM_DELAY} seconds"
        start_supply_demand(replayed, out, checkpoint, delay, available_now=True).awaitTermination()
    found = accounts(t.spark.read.parquet(source), out, checkpoint)
    slots = t.spark.read.schema(SLOT_COLUMNS).parquet(out)
    return rounded(slots, "relative_supply").withColumn("late_orders", F.lit(found.late).cast("bigint"))


@query(
    "a12_order_profile",
    f"""
    {_BASE}, {_TOTALS}, {_RATES}
    select totals.user_id, user_order_count, user_bidding_count, user_bidding_ok_count,
           user_bidding_accept_flag,
           round(user_bidding_accept_pct, 6) as user_bidding_accept_pct,
           round(coalesce(user_accept_avg_bidding_rate, -1e0), 6) as user_accept_avg_bidding_rate,
           coalesce(user_accept_25pct_bidding_rate, -1e0) as user_accept_25pct_bidding_rate,
           coalesce(user_accept_50pct_bidding_rate, -1e0) as user_accept_50pct_bidding_rate,
           coalesce(user_accept_75pct_bidding_rate, -1e0) as user_accept_75pct_bidding_rate
    from totals left join rates on rates.user_id = totals.user_id
    """,
)
def a12(t: Tables):
    profile = aggregates.order_profile(profile_base(dispatch_info(t), dispatch_detail(t)))
    return rounded(profile, "user_bidding_accept_pct", "user_accept_avg_bidding_rate")


@query(
    "a13_orders_per_user",
    "select o_custkey, count(*) as rows from orders group by o_custkey",
)
def a13(t: Tables):
    return aggregates.counts_by(t.orders, ["o_custkey"])


@query(
    "a13_orders_per_day",
    f"""
    {with_views("service_order")} select dt, count(*) as rows from service_order group by dt
    """,
)
def a13_days(t: Tables):
    return aggregates.counts_by(service_order(t), ["dt"])


@query(
    "a14_checks",
    """
    select count(*) filter (l_discount > 0) as surcharged,
           count(*) filter (l_discount = 0 or l_discount is null) as plain,
           count(*) filter (l_returnflag = 'A') as accepted,
           count(*) filter (l_shipdate is not null) as timed
    from lineitem
    """,
)
def a14(t: Tables):
    rate = F.col("l_discount")
    return aggregates.check_counts(
        t.lineitem,
        {
            "surcharged": rate > 0,
            "plain": (rate == 0) | rate.isNull(),
            "accepted": F.col("l_returnflag") == "A",
            "timed": F.col("l_shipdate").isNotNull(),
        },
    )
