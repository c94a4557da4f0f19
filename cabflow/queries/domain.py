"""Ride tables derived from the given ones.

Orders become service orders and estimates; line items become dispatch rounds, candidate
drivers, extensions and pricing rounds.  Each column is one expression that Spark and the
checking engine both understand, so both sides see the same rows.  The JSON and text
columns that the jobs parse exist on the Spark side only: the checks use the values that
went into them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.queries.base import Tables

# Local midnight of the first day; orders of one year share a day, and the years take turns.
FIRST_DAY = 20170401
MIDNIGHT = 1490976000
DATES = [str(FIRST_DAY + i) for i in range(7)]

_ORDER_DAY = "(year(o_orderdate) % 7)"
_ORDER_SECONDS = "((month(o_orderdate) - 1) * 7200 + o_orderkey % 600)"
_CREATED = f"({MIDNIGHT} + {_ORDER_DAY} * 86400 + {_ORDER_SECONDS})"

_LINE_DAY = "(l_suppkey % 7)"
_HOUR, _MINUTE, _SECOND = "(l_partkey % 24)", "(l_partkey % 60)", "(l_orderkey % 60)"
_LOGGED = (
    f"({MIDNIGHT} + {_LINE_DAY} * 86400 + {_HOUR} * 3600 + {_MINUTE} * 60 + {_SECOND})"
)
_DECIDED_AT = (
    f"case when l_tax = 0 then null when l_tax < 0.02 then 0"
    f" else {_LOGGED} + floor(l_quantity) end"
)
_CITY = "case when l_returnflag = 'N' then 'sh' else 'bj' end"


def _text(day: str, hour: str, minute: str, second: str, between: str) -> str:
    def two(number: str) -> str:
        return f"lpad(cast({number} as string), 2, '0')"

    return (
        f"concat('2017-04-0', cast(1 + {day} as string), '{between}',"
        f" {two(hour)}, ':', {two(minute)}, ':', {two(second)})"
    )


LINE_TIME = _text(_LINE_DAY, _HOUR, _MINUTE, _SECOND, " ")
LINE_PRICING_TIME = _text(_LINE_DAY, _HOUR, _MINUTE, _SECOND, "_")
_ORDER_HOUR = f"cast(floor({_ORDER_SECONDS} / 3600) as int)"
_ORDER_MINUTE = f"cast(floor({_ORDER_SECONDS} % 3600 / 60) as int)"
ORDER_PRICING_TIME = _text(
    _ORDER_DAY, _ORDER_HOUR, _ORDER_MINUTE, f"{_ORDER_SECONDS} % 60", "_"
)


def _order_columns(version: int) -> dict[str, str]:
    shift = "case when o_totalprice > 200000 then 60 else -60 end"
    return {
        "dt": f"cast({FIRST_DAY} + {_ORDER_DAY} as int)",
        "city": "case when o_orderpriority = '5-LOW' then 'sh' else 'bj' end",
        "service_order_id": "o_orderkey",
        "product_type_id": "cast(o_custkey % 9 as int)",
        "is_asap": "cast(o_orderkey % 2 as tinyint)",
        "flag": "o_orderkey % 2048",
        "account_id": "o_custkey + 7",
        "user_id": "o_custkey",
        "driver_id": "cast(o_custkey % 50 as int)",
        "corporate_id": "o_custkey % 11",
        "car_type_id": "cast(o_custkey % 5 as int)",
        "car_type": "concat('type', cast(o_custkey % 5 as string))",
        "car_brand": "o_orderpriority",
        "status": "cast(case o_orderstatus when 'F' then 7 when 'O' then 8 else 5 end as tinyint)",
        "rc_status": "cast(o_orderkey % 3 as tinyint)",
        "reason_id": "cast(o_orderkey % 4 as int)",
        "create_time": f"cast({_CREATED} as int)",
        "update_time": f"cast({_CREATED} + {(version - 1)} * ({shift}) as int)",
        "arrival_time": f"cast({_CREATED} + 300 as int)",
        "confirm_time": f"cast({_CREATED} + 100 as int)",
        "start_time": f"cast({_CREATED} + 400 as int)",
        "end_time": f"cast({_CREATED} + 1400 + {version} as int)",
        "start_position": "concat('p', cast(o_custkey as string))",
        "start_address": "concat('a', cast(o_custkey as string))",
        "end_position": "concat('q', cast(o_orderkey as string))",
        "end_address": "concat('b', cast(o_orderkey as string))",
        "expect_start_latitude": "cast(39.7 as double) + (o_custkey % 8) * cast(0.05 as double)",
        "expect_start_longitude": "cast(116.1 as double) + (o_orderkey % 8) * cast(0.05 as double)",
        "expect_end_latitude": "cast(39.8 as double) + (o_custkey % 9) * cast(0.05 as double)",
        "expect_end_longitude": "cast(116.2 as double) + (o_orderkey % 9) * cast(0.05 as double)",
        "start_latitude": "cast(39.7 as double)",
        "start_longitude": "cast(116.1 as double)",
        "end_latitude": "cast(39.9 as double)",
        "end_longitude": "cast(116.3 as double)",
        "coupon_name": "case when o_orderstatus = 'F' then 'welcome' end",
        "coupon_facevalue": "cast(o_custkey % 30 as decimal(8,2))",
        "dependable_distance": "cast(floor(o_totalprice / 1000) as int)",
        "actual_time_length": f"cast({version} as int)",
        "operation": "'UPDATE'",
    }


EXT_COLUMNS = {
    "dt": f"cast({FIRST_DAY} + {_LINE_DAY} as int)",
    "service_order_id": "l_orderkey",
    "update_time": f"cast({MIDNIGHT} + month(l_shipdate) * 86400 + l_linenumber as int)",
    "user_type": "cast(l_linenumber % 3 as tinyint)",
    "predict_amount": "cast(l_extendedprice as decimal(10,2))",
    "deadhead_distance": "cast(floor(l_quantity) as int)",
}
EXT_PARSED = {
    "estimate_distance": "case when l_returnflag <> 'N' then cast(l_partkey as string) end",
    "estimate_price": "cast(l_suppkey as string)",
}

INFO_COLUMNS = {
    "dt": f"cast({FIRST_DAY} + {_LINE_DAY} as int)",
    "service_order_id": "l_orderkey",
    "round": "cast(l_linenumber as tinyint)",
    "batch": "cast(1 + l_suppkey % 3 as tinyint)",
    "dispatch_time": f"cast({_LOGGED} + 5 as int)",
    "decision_time": f"cast({_DECIDED_AT} as int)",
    "create_time": f"cast({_LOGGED} - 10 as int)",
    "update_time": f"cast({_LOGGED} + 20 as int)",
    "status": "cast(l_linenumber % 4 as tinyint)",
    "bidding_id": "case when l_quantity < 5 then 0 else l_orderkey end",
    "dispatch_type": "cast(1 as tinyint)",
    "decision_type": "cast(1 + l_suppkey % 2 as tinyint)",
    "dispatch_count": "cast(floor(l_quantity) as smallint)",
    "response_count": "cast(floor(l_quantity / 4) as smallint)",
    "accept_count": "cast(case when l_returnflag = 'A' then 1 else 0 end as smallint)",
    "flag": "cast((l_suppkey % 4) * 512 as int)",
    "user_level": "cast(l_partkey % 6 as tinyint)",
    "user_gender": "l_linestatus",
    "can_dispatch_count": "cast(case when l_returnflag <> 'R' then floor(l_quantity / 2) end as smallint)",
    "decision_driver_id": "case when l_linestatus = 'F' then l_suppkey else 0 end",
    "decision_car_type_id": "cast(l_suppkey % 5 as tinyint)",
}
INFO_TABLE_ONLY = {
    "user_id": "l_partkey",
    "driver_bidding_rate": "l_discount",
    "city": _CITY,
}
INFO_PARSED = {
    "driver_bidding_rate": "l_discount",
    "user_bidding_rate": "l_tax",
    "driver_estimate_price": "floor(l_extendedprice)",
    "city": _CITY,
    "isRushHour": "cast(l_linenumber % 2 as string)",
    "remark": "l_returnflag",
    "batch_driver_count": "cast(l_linenumber * 10 as string)",
    "batch_interval": "cast(l_linenumber as string)",
    "contribution_pct": "'70'",
    "distanct_pct": "cast(l_suppkey % 100 as string)",
    "evaluation_pct": "'20'",
    "max_range": "'50000'",
    "code": "case when l_linenumber = 1 then 'first' else 'normal' end",
    "assign_max_range": "cast(l_partkey % 9000 as string)",
    "max_accept_count": "cast(l_linenumber + 2 as string)",
    "max_driver_count": "cast(l_suppkey % 40 as string)",
}

DETAIL_COLUMNS = {
    "dt": f"cast({FIRST_DAY} + {_LINE_DAY} as int)",
    "hour": f"cast({_HOUR} as int)",
    "service_order_id": "l_orderkey",
    "round": "cast(l_linenumber as tinyint)",
    "batch": "cast(1 + l_suppkey % 3 as tinyint)",
    "driver_id": "l_suppkey",
    "dispatch_time": f"cast({_LOGGED} + 5 as int)",
    "response_time": f"cast(case when l_returnflag = 'A' then {_LOGGED} + 9 else 0 end as int)",
    "accept_status": "cast(case when l_returnflag = 'A' then 1 else 0 end as tinyint)",
    "decision_time": f"cast({_DECIDED_AT} as int)",
    "decision_result": "cast(case when l_linestatus = 'F' then 2 else 1 end as tinyint)",
    "route_distance": "cast(floor(l_quantity) * 100 as int)",
    "route_time_length": "cast(floor(l_quantity) * 60 as int)",
    "distance": "cast(floor(l_quantity) * 90 as int)",
    "distance_time_length": "cast(floor(l_quantity) * 50 as int)",
    "driver_bidding_rate": "l_discount",
    "driver_estimate_price": "cast(floor(l_extendedprice) as int)",
    "city": _CITY,
}

ROUND_COLUMNS = {
    "dt": f"cast({FIRST_DAY} + {_LINE_DAY} as int)",
    "order_id": "l_orderkey",
    "bidding_id": "l_orderkey",
    "round": "cast(l_linenumber as int)",
}

PRE_COLUMNS = {
    "dt": f"cast({FIRST_DAY} + {_ORDER_DAY} as int)",
    "bidding_id": "o_orderkey",
}
PRE_PARSED = {
    "datetime": f"cast({_CREATED} as bigint)",
    "pre_productTypeId": "cast(o_custkey % 20 as double)",
    "pre_estimatePrice": "floor(o_totalprice)",
    "pre_availableDriverNum": "cast(o_custkey % 40 as double)",
    "pre_M": "cast(o_custkey % 10 as double) / 10",
}


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{expression} as {name}" for name, expression in columns.items()]


def _derived(table: DataFrame, columns: dict[str, str], **text: str) -> DataFrame:
    return table.selectExpr(*_named(columns), *_named(text))


# -- the Spark side --------------------------------------------------------------

_PARAMS = (
    "named_struct('bATCH_DRIVER_COUNT', l_linenumber * 10, 'bATCH_INTERVAL', l_linenumber,"
    " 'cONTRIBUTION', 70, 'dISTANCE', l_suppkey % 100, 'eVALUATION', 20, 'mAX_RANGE', 50000,"
    " 'aSSIGN_MAX_RANGE', l_partkey % 9000, 'mAX_ACCEPT_COUNT', l_linenumber + 2,"
    " 'mAX_DRIVER_COUNT', l_suppkey % 40)"
)


def service_order(t: Tables) -> DataFrame:
    """Two versions of every order; which is newer depends on its price."""
    versions = [_derived(t.orders, _order_columns(v)) for v in (1, 2)]
    return versions[0].unionByName(versions[1])


def service_order_ext(t: Tables) -> DataFrame:
    snap = (
        "to_json(named_struct('time_length', l_linenumber,"
        f" 'distance', {EXT_PARSED['estimate_distance']}, 'estimate_price', l_suppkey))"
    )
    return _derived(t.lineitem, EXT_COLUMNS, estimate_snap=snap, operation="'UPDATE'")


def dispatch_info(t: Tables) -> DataFrame:
    price = (
        "to_json(named_struct('dsb', l_discount, 'sb', l_tax,"
        " 'dep', cast(floor(l_extendedprice) as int)))"
    )
    template = (
        f"to_json(named_struct('city', {_CITY}, 'code', {INFO_PARSED['code']}, 'dispatchParams', {_PARAMS},"
        " 'isRushHour', l_linenumber % 2, 'remark', l_returnflag))"
    )
    return _derived(
        t.lineitem,
        INFO_COLUMNS | INFO_TABLE_ONLY,
        datetime=LINE_TIME,
        add_price_info=price,
        template_snapshot=template,
    )


def dispatch_detail(t: Tables) -> DataFrame:
    return _derived(t.lineitem, DETAIL_COLUMNS, datetime=LINE_TIME)


def _escaped(json: str) -> str:
    return rf"""replace({json}, '"', '\\"')"""


def pre_dispatch(t: Tables) -> DataFrame:
    payload = (
        "to_json(named_struct('productTypeId', o_custkey % 20,"
        " 'estimatePrice', cast(floor(o_totalprice) as int),"
        " 'availableDriverNum', o_custkey % 40, 'M', cast(o_custkey % 10 as double) / 10))"
    )
    return _derived(t.orders, PRE_COLUMNS, datetime=ORDER_PRICING_TIME, data=_escaped(payload))


def system_dispatch(t: Tables) -> DataFrame:
    payload = "to_json(named_struct('N', 0, 'totalMagnification', l_discount))"
    return _derived(
        t.lineitem, ROUND_COLUMNS, datetime=LINE_PRICING_TIME, data=_escaped(payload)
    )


def personal_dispatch(t: Tables) -> DataFrame:
    """Two drivers with rates, one of them a quoted number; no drivers for untaxed lines."""
    drivers = (
        "case when l_tax = 0 then '{}' else to_json(map("
        "cast(l_suppkey as string), named_struct('totalMagnification', cast(l_discount as string)),"
        " 'other', named_struct('totalMagnification', cast(l_tax as string)))) end"
    )
    # The map is an object inside the payload, not text.
    payload = f"""concat('{{"M":0.16,"driverData":', {drivers}, '}}')"""
    return _derived(
        t.lineitem, ROUND_COLUMNS, datetime=LINE_PRICING_TIME, data=_escaped(payload)
    )


def tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "service_order": service_order(t),
        "service_order_ext": service_order_ext(t),
        "dispatch_info": dispatch_info(t),
        "dispatch_detail": dispatch_detail(t),
        "pre_dispatch": pre_dispatch(t),
        "system_dispatch": system_dispatch(t),
        "personal_dispatch": personal_dispatch(t),
    }


# -- the checking side -----------------------------------------------------------


def _view(name: str, table: str, columns: dict[str, str]) -> str:
    listed = ",\n    ".join(_named(columns)).replace(" as string)", " as varchar)")
    return f"{name} as (\n  select\n    {listed}\n  from {table})"


def _version_view() -> str:
    first, second = (
        _view("x", "orders", _order_columns(v)).removeprefix("x as (").removesuffix(")")
        for v in (1, 2)
    )
    return f"service_order as ({first} union all {second})"


_LOGGED_AT = {"datetime": f"cast({_LOGGED} as bigint)"}

VIEWS = {
    "service_order": _version_view(),
    "service_order_ext": _view("service_order_ext", "lineitem", EXT_COLUMNS | EXT_PARSED),
    "dispatch_rounds": _view(
        "dispatch_rounds",
        "lineitem",
        INFO_COLUMNS | _LOGGED_AT | INFO_PARSED | {"user_id": "l_partkey"},
    ),
    "dispatch_detail": _view("dispatch_detail", "lineitem", DETAIL_COLUMNS | _LOGGED_AT),
    "pre_dispatch": _view("pre_dispatch", "orders", PRE_COLUMNS | PRE_PARSED),
    "system_dispatch": _view(
        "system_dispatch", "lineitem", ROUND_COLUMNS | _LOGGED_AT | {"rate": "l_discount"}
    ),
    "personal_dispatch": _view(
        "personal_dispatch",
        "lineitem",
        ROUND_COLUMNS
        | _LOGGED_AT
        | {
            "low": "case when l_tax = 0 then 0 else least(l_discount, l_tax) end",
            "high": "case when l_tax = 0 then 0 else greatest(l_discount, l_tax) end",
        },
    ),
}


def with_views(*names: str) -> str:
    """``with a as (...), b as (...)`` for the named views."""
    return "with " + ",\n".join(VIEWS[name] for name in names)


def with_views_of(day: str, city: str, *names: str) -> str:
    """The same for one day and, where a table says where its rows are from, one city."""
    cities = {"service_order", "dispatch_rounds", "dispatch_detail"}

    def scoped(name: str) -> str:
        body = VIEWS[name].removeprefix(f"{name} as (").removesuffix(")")
        where = f"dt = {day}" + (f" and city = '{city}'" if name in cities else "")
        return f"{name} as (select * from ({body}) every_row where {where})"

    return "with " + ",\n".join(scoped(name) for name in names)
