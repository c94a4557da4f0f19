"""Projections, filters, one row per key, numbering and unions (P, F, D, W, U)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cabflow.functions.times import day_bounds
from cabflow.operators import filters
from cabflow.operators.joins import semi, union_all
from cabflow.operators.numbering import batch_number, top_k_per_key
from cabflow.operators.picking import (
    any_per_key,
    compact_changes,
    distinct_on,
    earliest_per_key,
    latest_per_key,
    preview,
)
from cabflow.operators.shaping import project, renamed, stamped
from cabflow.plans.dispatch import dispatch_rounds
from cabflow.queries.base import Tables, query
from cabflow.queries.domain import DATES, dispatch_info, service_order, with_views
from cabflow.schemas import fields

# -- projections -----------------------------------------------------------------


@query("p1_project", "select o_orderkey, o_custkey, o_orderstatus from orders")
def p1(t: Tables):
    return project(t.orders, fields("o_orderkey:bigint o_custkey:bigint o_orderstatus:string"))


@query(
    "p2_rename",
    """
    select l_orderkey as service_order_id, l_linenumber as round, l_suppkey as driver_id,
           l_discount as driver_bidding_rate
    from lineitem
    """,
)
def p2(t: Tables):
    return renamed(
        t.lineitem,
        {
            "service_order_id": "l_orderkey",
            "round": "l_linenumber",
            "driver_id": "l_suppkey",
            "driver_bidding_rate": "l_discount",
        },
    )


@query("p3_constant", "select o_orderkey, 20170401 as dt from orders")
def p3(t: Tables):
    return stamped(t.orders.select("o_orderkey"), DATES[0])


# -- filters -----------------------------------------------------------------------


@query(
    "f1_day_and_city",
    f"""
    {with_views("service_order")}
    select service_order_id, dt, city from service_order where dt = {DATES[0]} and city = 'bj'
    """,
)
def f1(t: Tables):
    day = filters.of_days(service_order(t), DATES[:1])
    return filters.of_city(day, "bj").select("service_order_id", "dt", "city")


@query(
    "f2_finished",
    f"""
    {with_views("service_order")}
    select service_order_id, cast(status as int) as status, update_time
    from service_order where status in (7, 8)
    """,
)
def f2(t: Tables):
    return filters.finished(service_order(t)).select(
        "service_order_id", F.col("status").cast("int").alias("status"), "update_time"
    )


_DAY_START, _DAY_END = day_bounds(DATES[2])


@query(
    "f3_local_day",
    f"""
    {with_views("service_order")}
    select service_order_id, create_time, update_time from service_order
    where create_time between {_DAY_START} and {_DAY_END}
    """,
)
def f3(t: Tables):
    return filters.in_local_days(service_order(t), "create_time", DATES[2:3]).select(
        "service_order_id", "create_time", "update_time"
    )


@query(
    "f4_city_in_json",
    f"""
    {with_views("dispatch_rounds")}
    select service_order_id, city, remark from dispatch_rounds where city = 'bj'
    """,
)
def f4(t: Tables):
    return dispatch_rounds(dispatch_info(t), city="bj").select(
        "service_order_id", "city", "remark"
    )


@query(
    "f5_in_subquery",
    """
    select o_orderkey, o_custkey from orders
    where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')
    """,
)
def f5(t: Tables):
    keys = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return semi(t.orders.select("o_orderkey", "o_custkey"), keys, ["o_orderkey"])


@query(
    "f6_parsed",
    """
    select event_id, try_cast(case when event_type = 'view' then 'x'
                              else cast(user_id as varchar) end as bigint) as key
    from events where event_type <> 'view'
    """,
)
def f6(t: Tables):
    text = F.when(F.col("event_type") == "view", "x").otherwise(F.col("user_id").cast("string"))
    keyed = t.events.select("event_id", text.try_cast("bigint").alias("key"))
    return filters.parsed(keyed, "key")


@query(
    "f7_not_deleted",
    """
    select event_id from (select event_id, case event_type when 'error' then 'DELETE'
        when 'view' then null else 'UPDATE' end as operation from events) changes
    where operation <> 'DELETE'
    """,
)
def f7(t: Tables):
    operation = (
        F.when(F.col("event_type") == "error", "DELETE")
        .when(F.col("event_type") == "view", None)
        .otherwise("UPDATE")
    )
    changes = t.events.select("event_id", operation.alias("operation"))
    return changes.where(filters.changed_not_deleted("operation")).select("event_id")


@query(
    "f8_with_value",
    f"""
    {with_views("dispatch_rounds")}
    select service_order_id, decision_driver_id from dispatch_rounds where decision_driver_id > 0
    """,
)
def f8(t: Tables):
    return filters.with_value(dispatch_info(t), "decision_driver_id").select(
        "service_order_id", "decision_driver_id"
    )


_RATES_SQL = """
    select l_orderkey, l_partkey, l_suppkey,
           case when l_tax = 0 then null else l_discount end as final_max_bidding_rate,
           case when l_returnflag = 'N' then null else l_linenumber end as end_bidding_round
    from lineitem
"""


@query(
    "f9_three_valued",
    f"""
    select * from ({_RATES_SQL}) rated
    where not (final_max_bidding_rate > 0 and end_bidding_round is null)
    """,
)
def f9(t: Tables):
    rate = F.when(F.col("l_tax") == 0, None).otherwise(F.col("l_discount"))
    last = F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_linenumber"))
    rated = t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        rate.alias("final_max_bidding_rate"),
        last.alias("end_bidding_round"),
    )
    return filters.no_contradiction(rated)


@query(
    "f10_complete",
    """
    select l_orderkey, l_partkey, l_suppkey, l_quantity as avg_can_dispatch,
           l_linenumber as abs_demand,
           case when l_returnflag = 'N' then null else l_tax - 0.01e0 end as relative_supply
    from lineitem
    where l_returnflag <> 'N' and l_tax - 0.01e0 >= 0
    """,
)
def f10(t: Tables):
    supply = F.when(F.col("l_returnflag") == "N", None).otherwise(F.col("l_tax") - 0.01)
    return filters.complete(
        t.lineitem.select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            F.col("l_quantity").alias("avg_can_dispatch"),
            F.col("l_linenumber").alias("abs_demand"),
            supply.alias("relative_supply"),
        )
    )


@query(
    "f11_risk_only",
    """
    select o_orderkey, 'T' as is_rc from orders where o_orderstatus = 'F'
    """,
)
def f11(t: Tables):
    flag = F.when(F.col("o_orderstatus") == "F", "T").when(F.col("o_orderstatus") == "O", "F")
    return filters.risk_only(t.orders.select("o_orderkey", flag.alias("is_rc")))


@query(
    "f12_date_prefix",
    """
    select event_id, strftime(ts, '%Y%m%d%H') as dt from events where strftime(ts, '%Y%m%d') = '20240107'
    """,
)
def f12(t: Tables):
    stamps = t.events.select("event_id", F.date_format("ts", "yyyyMMddHH").alias("dt"))
    return filters.date_prefix(stamps, "20240107")


@query(
    "f13_not_null_after_join",
    """
    select o_orderkey, l_partkey from orders join lineitem on l_orderkey = o_orderkey
    """,
)
def f13(t: Tables):
    parts = t.lineitem.select("l_orderkey", "l_partkey")
    joined = t.orders.select("o_orderkey").join(
        parts, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    return filters.known(joined, "l_partkey").select("o_orderkey", "l_partkey")


@query(
    "f14_priced",
    f"""
    {with_views("dispatch_rounds")}
    select service_order_id, bidding_id, decision_driver_id from dispatch_rounds
    where bidding_id > 0 and decision_driver_id > 0
    """,
)
def f14(t: Tables):
    return filters.priced(dispatch_info(t), decided=True).select(
        "service_order_id", "bidding_id", "decision_driver_id"
    )


# -- one row per key -----------------------------------------------------------------

_LINE = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,"
    " l_tax, l_returnflag, l_linestatus"
)
_REST = [
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus",
]


def _by(columns: list[str], direction: str) -> str:
    nulls = "last" if direction == "desc" else "first"
    return ", ".join(f"{c} {direction} nulls {nulls}" for c in columns)


def first_row_sql(source: str, keys: str, order: str, columns: str) -> str:
    return f"""
        select {columns} from (
            select *, row_number() over (partition by {keys} order by {order}) as rn
            from {source}
        ) ranked where rn = 1
    """


def _lines(t: Tables):
    return t.lineitem


@query(
    "d1_latest",
    first_row_sql("lineitem", "l_orderkey", _by(["l_shipdate", *_REST], "desc"), _LINE),
)
def d1(t: Tables):
    return latest_per_key(_lines(t), ["l_orderkey"], ["l_shipdate"]).drop("l_shipdate")


_DECIDED = "case when l_tax = 0 then null else epoch_us(l_shipdate) end"


@query(
    "d2_earliest",
    first_row_sql(
        f"(select *, {_DECIDED} as decided_at from lineitem where l_returnflag = 'A') lines",
        "l_orderkey",
        _by(["decided_at", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"], "asc"),
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, decided_at",
    ),
)
def d2(t: Tables):
    micros = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint") * 86400 * 1000000
    rows = t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_tax") == 0, None).otherwise(micros).alias("decided_at"),
        "l_returnflag",
    )
    first = earliest_per_key(
        rows, ["l_orderkey"], ["decided_at"], where=F.col("l_returnflag") == "A"
    )
    return first.drop("l_quantity", "l_returnflag")


@query(
    "d3_max_round",
    first_row_sql(
        "lineitem", "l_orderkey", _by(["l_linenumber", "l_partkey", "l_suppkey"], "desc"),
        "l_orderkey, l_linenumber, l_partkey, l_suppkey",
    ),
)
def d3(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return latest_per_key(rows, ["l_orderkey"], ["l_linenumber"])


@query(
    "d4_any",
    first_row_sql("orders", "o_custkey", "o_orderkey", "o_custkey, o_orderkey, o_orderstatus"),
)
def d4(t: Tables):
    return any_per_key(t.orders.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"])


@query(
    "d5_distinct_on",
    first_row_sql(
        "lineitem", "l_orderkey, l_shipdate", _by(_REST, "asc"),
        _LINE,
    ),
)
def d5(t: Tables):
    rows = t.lineitem.select(*_LINE.split(", "), "l_shipdate")
    return distinct_on(rows, ["l_orderkey", "l_shipdate"]).drop("l_shipdate")


@query(
    "d6_preview",
    "select 5 as rows, cast(5 as bigint) as known",
)
def d6(t: Tables):
    """Rows of the preview, and how many of them the table knows."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    there = t.lineitem.select(*keys).distinct().withColumn("_there", F.lit(1))
    seen = preview(t.lineitem, 5).select(*keys).join(there, keys, "left")
    return seen.agg(F.count(F.lit(1)).cast("int").alias("rows"), F.count("_there").alias("known"))


# -- numbering -----------------------------------------------------------------------

_TIES = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    "w1_batch_number",
    f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey,
           cast(row_number() over (partition by l_orderkey
                order by l_linenumber, {", ".join(_TIES)}) as bigint) as acc_batch
    from lineitem
    """,
)
def w1(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", *_TIES)
    numbered = batch_number(
        rows,
        ["l_orderkey"],
        ["l_linenumber", "l_shipdate"],
        "acc_batch",
        tiebreak=_TIES[1:],
    )
    return numbered.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "acc_batch")


@query(
    "w1_one_hot_key",
    """
    select l_linestatus, l_partkey, l_suppkey, l_orderkey, l_linenumber,
           cast(row_number() over (partition by l_linestatus
                order by l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate,
                         l_extendedprice) as bigint) as acc_batch
    from lineitem
    """,
)
def w1_hot(t: Tables):
    """Two keys over the whole table; each goes over many ranges."""
    rows = t.lineitem.select(
        "l_linestatus", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate",
        "l_extendedprice",
    )
    numbered = batch_number(
        rows,
        ["l_linestatus"],
        ["l_partkey", "l_suppkey"],
        "acc_batch",
        tiebreak=["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"],
    )
    return numbered.drop("l_shipdate", "l_extendedprice")


@query(
    "w2_window_after_group",
    """
    select l_orderkey, l_linenumber, count(*) as drivers,
           cast(row_number() over (partition by l_orderkey order by l_linenumber) as int)
               as acc_batch
    from lineitem group by l_orderkey, l_linenumber
    """,
)
def w2(t: Tables):
    grouped = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("drivers")
    )
    numbered = batch_number(grouped, ["l_orderkey"], ["l_linenumber"], "acc_batch")
    return numbered.withColumn("acc_batch", F.col("acc_batch").cast("int"))


@query(
    "w3_cdc_latest",
    """
    select user_id, event_id, event_type as operation from (
        select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
        from events where user_id is not null
    ) ranked where rn = 1 and event_type <> 'error'
    """,
)
def w3(t: Tables):
    operation = F.when(F.col("event_type") == "error", "DELETE").otherwise(F.col("event_type"))
    changes = t.events.select("user_id", "ts", "event_id", operation.alias("operation"))
    return compact_changes(changes, "user_id", "ts", "operation").drop("ts")


@query(
    "w4_top_k",
    """
    select user_id, event_id, value from (
        select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
        from events
    ) ranked where rn < 3
    """,
)
def w4(t: Tables):
    rows = t.events.select("user_id", "event_id", "value", "ts")
    return top_k_per_key(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")], 2).drop("ts")


# -- unions --------------------------------------------------------------------------


@query(
    "u1_days",
    f"""
    {with_views("service_order")}
    select service_order_id, dt, update_time from service_order
    """,
)
def u1(t: Tables):
    rows = service_order(t).select("service_order_id", "dt", "update_time")
    return union_all(*[filters.of_days(rows, [day]) for day in DATES])


@query(
    "u2_by_name",
    """
    select l_orderkey as bidding_id, l_discount as low, l_discount as high from lineitem
    union all
    select l_orderkey, least(l_discount, l_tax), greatest(l_discount, l_tax) from lineitem
    """,
)
def u2(t: Tables):
    """The columns of the two sides come in a different order."""
    one = t.lineitem.select(
        F.col("l_orderkey").alias("bidding_id"),
        F.col("l_discount").alias("low"),
        F.col("l_discount").alias("high"),
    )
    two = t.lineitem.select(
        F.greatest("l_discount", "l_tax").alias("high"),
        F.least("l_discount", "l_tax").alias("low"),
        F.col("l_orderkey").alias("bidding_id"),
    )
    return union_all(one, two)


@query(
    "u3_concat",
    """
    select c_custkey as key, c_name as name from customer
    union all select s_suppkey, s_name from supplier
    """,
)
def u3(t: Tables):
    customers = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return union_all(customers, suppliers)
