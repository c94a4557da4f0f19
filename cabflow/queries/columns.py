"""Column expressions (X1 to X22)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cabflow.functions import rules
from cabflow.functions.geo import ALPHABET, geo_time_key, geohash
from cabflow.functions.payloads import json_fields, number, payload_driver_rates, unescape
from cabflow.functions.times import (
    LOG_TIME,
    PRICING_TIME,
    date_range,
    effective_time,
    epoch_of,
    floor_5min,
    hour_of_day,
    iso_weekday,
    to_epoch,
    wait_time,
)
from cabflow.operators.shaping import with_json
from cabflow.queries.base import Tables, query
from cabflow.queries.domain import (
    DATES,
    dispatch_detail,
    dispatch_info,
    personal_dispatch,
    pre_dispatch,
    service_order,
    with_views,
)

TZ_HOURS = 8


@query(
    "x1_json_fields",
    """
    select event_id, json_extract_string(props, '$.k') as k,
           cast(null as varchar) as missing
    from events
    """,
)
def x1(t: Tables):
    fields = json_fields(F.col("props"), "k", "missing")
    return t.events.select("event_id", fields["k"].alias("k"), fields["missing"].alias("missing"))


@query(
    "x2_nested_json",
    f"""
    {with_views("dispatch_rounds")}
    select service_order_id, city, batch_driver_count, max_range from dispatch_rounds
    """,
)
def x2(t: Tables):
    template = {"city": "city", "params": "dispatchParams"}
    params = {"batch_driver_count": "bATCH_DRIVER_COUNT", "max_range": "mAX_RANGE"}
    rows = dispatch_info(t).select("service_order_id", "template_snapshot")
    rows = with_json(rows, F.col("template_snapshot"), template)
    return with_json(rows, F.col("params"), params).drop("template_snapshot", "params")


@query(
    "x3_unescape",
    """
    select event_id, props as payload from events
    """,
)
def x3(t: Tables):
    escaped = F.replace(F.col("props"), F.lit('"'), F.lit('\\"'))
    return t.events.select("event_id", unescape(escaped).alias("payload"))


@query(
    "x4_driver_rates",
    f"""
    {with_views("personal_dispatch")}
    select bidding_id, round, cast(low as double) as low, cast(high as double) as high
    from personal_dispatch
    """,
)
def x4(t: Tables):
    rates = personal_dispatch(t).withColumn("rates", payload_driver_rates(unescape(F.col("data"))))
    return rates.select("bidding_id", "round", "rates.low", "rates.high")


@query(
    "x5_text_to_epoch",
    f"""
    {with_views("dispatch_detail")}
    select service_order_id, driver_id, datetime as logged, cast(null as bigint) as bad
    from dispatch_detail
    """,
)
def x5(t: Tables):
    return dispatch_detail(t).select(
        "service_order_id",
        "driver_id",
        to_epoch(F.col("datetime"), LOG_TIME).alias("logged"),
        to_epoch(F.concat(F.lit("x"), F.col("datetime")), LOG_TIME).alias("bad"),
    )


@query(
    "x5_pricing_time",
    f"""
    {with_views("pre_dispatch")}
    select bidding_id, datetime as logged from pre_dispatch
    """,
)
def x5_pricing(t: Tables):
    return pre_dispatch(t).select(
        "bidding_id", to_epoch(F.col("datetime"), PRICING_TIME).alias("logged")
    )


@query(
    "x6_weekday",
    f"""
    select event_id, cast(isodow(ts + interval {TZ_HOURS} hour) as int) as day_of_week from events
    """,
)
def x6(t: Tables):
    return t.events.select("event_id", iso_weekday(epoch_of(F.col("ts"))).alias("day_of_week"))


@query(
    "x7_hour",
    f"""
    select event_id, cast(hour(ts + interval {TZ_HOURS} hour) as int) as hour_of_day from events
    """,
)
def x7(t: Tables):
    return t.events.select("event_id", hour_of_day(epoch_of(F.col("ts"))).alias("hour_of_day"))


def geohash_sql(lat: str, lon: str) -> str:
    """Five letters of 13 longitude and 12 latitude bits, as SQL."""
    x = f"least(cast(floor(({lon} + 180) / 360 * 8192) as bigint), 8191)"
    y = f"least(cast(floor(({lat} + 90) / 180 * 4096) as bigint), 4095)"

    def bit(i: int) -> str:
        slot, bits = (x, 13) if i % 2 == 0 else (y, 12)
        return f"(({slot} >> {bits - 1 - i // 2}) & 1)"

    def letter(n: int) -> str:
        code = " + ".join(f"{bit(5 * n + i)} * {2 ** (4 - i)}" for i in range(5))
        return f"substr('{ALPHABET}', cast({code} as int) + 1, 1)"

    return reduce(lambda a, b: f"{a} || {b}", [letter(n) for n in range(5)])


_WIDE = {
    "lat": "cast(c_acctbal as double) / 200 + 30",
    "lon": "cast(c_custkey * 37 % 3600 as double) / 10 - 180",
}


@query(
    "x8_geohash",
    f"""
    select c_custkey, case when lat between -90 and 90 then {geohash_sql("lat", "lon")} end as geo
    from (select c_custkey, {_WIDE["lat"]} as lat, {_WIDE["lon"]} as lon from customer) placed
    """,
)
def x8(t: Tables):
    placed = t.customer.selectExpr("c_custkey", *[f"{e} as {n}" for n, e in _WIDE.items()])
    return placed.select("c_custkey", geohash(F.col("lat"), F.col("lon")).alias("geo"))


@query(
    "x9_floor_5min",
    """
    select event_id, (epoch_us(ts) // 1000000) // 300 * 300 as slot from events
    """,
)
def x9(t: Tables):
    return t.events.select("event_id", floor_5min(epoch_of(F.col("ts"))).alias("slot"))


GEO_KEY_SQL = (
    geohash_sql("expect_start_latitude", "expect_start_longitude")
    + " || '_' || cast(order_create_time // 300 * 300 as varchar)"
)


@query(
    "x10_geo_time_key",
    f"""
    {with_views("service_order")}
    select service_order_id, update_time, {GEO_KEY_SQL} as geo_time_key
    from (select *, create_time as order_create_time from service_order) placed
    """,
)
def x10(t: Tables):
    key = geo_time_key(
        F.col("create_time"), F.col("expect_start_latitude"), F.col("expect_start_longitude")
    )
    return service_order(t).select(
        "service_order_id", "update_time", key.alias("geo_time_key")
    )


@query(
    "x11_decision_type",
    """
    select o_orderkey,
           case when (o_orderkey & 1024) = 1024 then 'system_decision'
                when (o_orderkey & 512) = 512 then 'manual_decision'
                else 'unkown' end as decision_type_flag
    from orders
    """,
)
def x11(t: Tables):
    return t.orders.select(
        "o_orderkey", rules.decision_type(F.col("o_orderkey")).alias("decision_type_flag")
    )


# A line as the outcome of an order: -1, 0, a supplier or nothing as its driver, and rates
# that may be zero or missing.
_OUTCOME = {
    "driver": "case when l_quantity < 10 then null when l_quantity < 20 then 0"
    " when l_quantity < 22 then -1 else l_suppkey end",
    "rate": "case when l_tax = 0 then null else l_discount end",
    "max_rate": "case when l_tax < 0.03 then null else l_tax - 0.03 end",
    "end_rate": "case when l_returnflag = 'N' then null when l_returnflag = 'A' then 0e0"
    " else l_discount end",
}
_LINE_ID = "l_orderkey, l_linenumber, l_suppkey, l_partkey"
_OUTCOMES_SQL = (
    f"(select {_LINE_ID}, "
    + ", ".join(f"{e} as {n}" for n, e in _OUTCOME.items())
    + " from lineitem) outcomes"
)


def _outcomes(t: Tables):
    return t.lineitem.selectExpr(
        *_LINE_ID.split(", "), *[f"{e} as {n}" for n, e in _OUTCOME.items()]
    )


LABEL_SQL = """
    case when {driver} > 0 and {rate} > 0 then 'bidding_decision_ok'
         when {end} > 0 and ({driver} = 0 or {driver} is null) then 'bidding_decision_failed'
         when ({end} = 0 or {end} is null) and {driver} > 0 then 'no_bidding_decision_ok'
         when ({end} = 0 or {end} is null) and ({driver} = 0 or {driver} is null)
              then 'no_bidding_decision_failed'
         else 'unkown' end
"""
ADJUST_SQL = """
    cast(case when {driver} > 0 then {rate}
              when ({driver} = 0 or {driver} is null) and {max} > 0 then {end}
              when ({driver} = 0 or {driver} is null) and {end} > 0 then {end}
              else 0 end as double)
"""
_OUTCOME_NAMES = {"driver": "driver", "rate": "rate", "end": "end_rate", "max": "max_rate"}


@query(
    "x12_label",
    f"select {_LINE_ID}, {LABEL_SQL.format(**_OUTCOME_NAMES)} as label from {_OUTCOMES_SQL}",
)
def x12(t: Tables):
    label = rules.label(F.col("driver"), F.col("rate"), F.col("end_rate"))
    return _outcomes(t).select(*_LINE_ID.split(", "), label.alias("label"))


@query(
    "x13_rate_adjust",
    f"select {_LINE_ID}, {ADJUST_SQL.format(**_OUTCOME_NAMES)} as rate_adjust"
    f" from {_OUTCOMES_SQL}",
)
def x13(t: Tables):
    adjusted = rules.rate_adjust(
        F.col("driver"), F.col("rate"), F.col("max_rate"), F.col("end_rate")
    )
    return _outcomes(t).select(*_LINE_ID.split(", "), adjusted.alias("rate_adjust"))


ACCEPT_SQL = """
    case when {n} = 0 then -1
         when {n} > 0 and {ok} = 0 then 0
         when {n} > 0 and {ok} > 0 and {n} > {ok} then 1
         when {n} > 0 and {ok} > 0 and {n} = {ok} then 2
         else -2 end
"""


@query(
    "x14_accept_flag",
    f"""
    select p_partkey, {ACCEPT_SQL.format(n="p_size % 5", ok="p_partkey % 6")} as accept_flag
    from part
    """,
)
def x14(t: Tables):
    flag = rules.accept_flag(F.expr("p_size % 5"), F.expr("p_partkey % 6"))
    return t.part.select("p_partkey", flag.alias("accept_flag"))


@query(
    "x15_effective_time",
    f"""
    {with_views("dispatch_detail")}
    select service_order_id, round, driver_id,
           cast(case when decision_time > 0 then decision_time else datetime end as bigint) as ended
    from (select * replace (cast(round as int) as round) from dispatch_detail) detail
    """,
)
def x15(t: Tables):
    ended = effective_time(F.col("decision_time"), to_epoch(F.col("datetime")))
    return dispatch_detail(t).select(
        "service_order_id", F.col("round").cast("int").alias("round"), "driver_id",
        ended.alias("ended"),
    )


@query(
    "x16_indicators",
    f"""
    select {_LINE_ID},
           case when driver > 0 then 1 else 0 end as is_decision_ok,
           case when rate > 0 or max_rate > 0 then 1 else 0 end as is_bidding,
           case when driver > 0 and rate > 0 then 1 else 0 end as is_bidding_ok
    from {_OUTCOMES_SQL}
    """,
)
def x16(t: Tables):
    driver, rate = F.col("driver"), F.col("rate")
    return _outcomes(t).select(
        *_LINE_ID.split(", "),
        rules.is_decided(driver).alias("is_decision_ok"),
        rules.is_surcharged(rate, F.col("max_rate")).alias("is_bidding"),
        rules.is_accepted(driver, rate).alias("is_bidding_ok"),
    )


@query(
    "x17_default",
    f"select {_LINE_ID}, coalesce(end_rate, -1e0) as end_rate from {_OUTCOMES_SQL}",
)
def x17(t: Tables):
    return _outcomes(t).select(
        *_LINE_ID.split(", "), rules.or_minus1(F.col("end_rate")).alias("end_rate")
    )


@query(
    "x18_wait_time",
    f"""
    {with_views("dispatch_detail")}
    select service_order_id, driver_id, decision_time - dispatch_time as wait_time
    from dispatch_detail
    """,
)
def x18(t: Tables):
    wait = wait_time(F.col("decision_time"), F.col("dispatch_time"))
    return dispatch_detail(t).select("service_order_id", "driver_id", wait.alias("wait_time"))


@query(
    "x19_ratio",
    """
    select p_partkey, p_retailprice / nullif(p_size % 4, 0) as quotient from part
    """,
)
def x19(t: Tables):
    return t.part.select(
        "p_partkey", rules.ratio(F.col("p_retailprice"), F.expr("p_size % 4")).alias("quotient")
    )


@query(
    "x20_casts",
    """
    select o_orderkey,
           try_cast(case when o_orderstatus = 'F' then 'x' else cast(o_custkey as varchar) end
                    as int) as as_int,
           cast(cast(o_totalprice as float) as double) as as_float,
           cast(cast(o_totalprice as decimal(10,1)) as double) as as_decimal
    from orders
    """,
)
def x20(t: Tables):
    text = F.when(F.col("o_orderstatus") == "F", "x").otherwise(F.col("o_custkey").cast("string"))
    price = F.col("o_totalprice").cast("string")
    return t.orders.select(
        "o_orderkey",
        rules.typed(text, "int").alias("as_int"),
        rules.typed(price, "float").cast("double").alias("as_float"),
        rules.typed(price, "decimal(10,1)").cast("double").alias("as_decimal"),
    )


def _day_list(t: Tables, inclusive: bool):
    days = date_range(DATES[0], DATES[-1], inclusive)
    placed = service_order(t).where(F.col("dt").cast("string").isin(days))
    return placed.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "x21_date_range",
    f"""
    {with_views("service_order")}
    select dt, count(*) as rows from service_order where dt >= {DATES[0]} and dt < {DATES[-1]}
    group by dt
    """,
)
def x21(t: Tables):
    return _day_list(t, inclusive=False)


@query(
    "x22_date_range_inclusive",
    f"""
    {with_views("service_order")}
    select dt, count(*) as rows from service_order where dt >= {DATES[0]} and dt <= {DATES[-1]}
    group by dt
    """,
)
def x22(t: Tables):
    return _day_list(t, inclusive=True)


@query(
    "x20_number_from_json",
    """
    select event_id, cast(json_extract_string(props, '$.k') as double) as k from events
    """,
)
def x20_json(t: Tables):
    k = number(json_fields(F.col("props"), "k")["k"])
    return t.events.select("event_id", k.alias("k"))
