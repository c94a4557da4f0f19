"""Sources, sinks and streams (S, K, T).

The text these read is made from the given tables, whole; written files go to a new
folder below the shared one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.times import epoch_of
from cabflow.plans.imports import devices, export_rows, update_risk_orders
from cabflow.plans.kpi import kpi_table, refresh_dispatch_kpi
from cabflow.plans.logs import convert_log, current_state, typed_log
from cabflow.queries.base import Tables, query
from cabflow.queries.domain import (
    DATES,
    LINE_PRICING_TIME,
    LINE_TIME,
    MIDNIGHT,
    ORDER_PRICING_TIME,
    dispatch_info,
    service_order,
    with_views,
)
from cabflow.queries.groups import KPI_SQL
from cabflow.schemas import CONTROL_A, IMPORTS, LOGS, TWO_PIPES, fields, ods_schema
from cabflow.session import scratch_path
from cabflow.sinks import writers
from cabflow.sources import tables as stored
from cabflow.sources import text
from cabflow.streaming.landing import land_stream

_ORDER_FIELDS = fields("id:bigint user:int status:string price:double priority:string")


def _delimited(t: Tables, sep: str) -> DataFrame:
    """Orders as lines: one status is missing, one makes the user a bad number."""
    user = F.when(F.col("o_orderstatus") == "P", "x").otherwise(F.col("o_custkey").cast("string"))
    status = F.when(F.col("o_orderstatus") == "O", text.NULL_TOKEN).otherwise(
        F.col("o_orderstatus")
    )
    priority = F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority"))
    parts: list[Column] = [
        F.col("o_orderkey").cast("string"),
        user,
        status,
        F.col("o_totalprice").cast("string"),
        priority,
    ]
    return t.orders.select(F.concat_ws(sep, *parts).alias("value"))


_DELIMITED_SQL = """
    select o_orderkey as id,
           case when o_orderstatus = 'P' then null else cast(o_custkey as int) end as "user",
           case when o_orderstatus = 'O' then null else o_orderstatus end as status,
           o_totalprice as price,
           case when o_orderpriority = '5-LOW' then '' else o_orderpriority end as priority
    from orders
"""


@query("s1_control_a", _DELIMITED_SQL)
def s1(t: Tables):
    return text.parse_delimited(_delimited(t, CONTROL_A), _ORDER_FIELDS, CONTROL_A)


@query("s2_two_pipes", _DELIMITED_SQL)
def s2(t: Tables):
    """The same through files."""
    path = scratch_path(t.spark, "lines")
    _delimited(t, TWO_PIPES).write.text(path)
    return text.read_delimited(t.spark, path, _ORDER_FIELDS, TWO_PIPES)


def _log(t: Tables, name: str, table: str, expression: str) -> DataFrame:
    return typed_log(getattr(t, table).selectExpr(f"{expression} as value"), name)


@query(
    "s3_access_pattern",
    """
    select cast(event_id as varchar) as timestamp, 'INFO' as tag, '/' || event_type as operation,
           props as request, '{"v": ' || cast(user_id as varchar) || '}' as result
    from events where event_type <> 'error'
    """,
)
def s3(t: Tables):
    """Lines of one kind of event do not have the form and are dropped."""
    return _log(
        t,
        "bidding_access",
        "events",
        "case when event_type = 'error' then 'broken' else concat('x [', cast(event_id as string),"
        " '] INFO /', event_type, ' ', props, ' - took 0.5 ',"
        """ '{"v": ', cast(user_id as string), '} end') end""",
    )


@query(
    "s4_pre_pattern",
    f"""
    select {ORDER_PRICING_TIME.replace(" as string)", " as varchar)")} as datetime,
           o_orderkey as bidding_id, '{{"M":' || cast(o_custkey as varchar) || '}}' as data
    from orders where o_orderstatus <> 'F'
    """,
)
def s4(t: Tables):
    """Lines without an id have none, so they are dropped as well."""
    return _log(
        t,
        "pre_dispatch",
        "orders",
        f"concat('log ', {ORDER_PRICING_TIME}, ' - ',"
        " case when o_orderstatus = 'F' then '' else cast(o_orderkey as string) end,"
        """ ' - {"M":', cast(o_custkey as string), '}"}')""",
    )


@query(
    "s5_round_pattern",
    f"""
    select {LINE_PRICING_TIME.replace(" as string)", " as varchar)")} as datetime,
           l_orderkey as order_id, l_partkey as bidding_id, l_linenumber as round,
           '{{"M":' || cast(l_suppkey as varchar) || '}}' as data
    from lineitem where l_returnflag <> 'N'
    """,
)
def s5(t: Tables):
    return _log(
        t,
        "system_dispatch",
        "lineitem",
        f"concat('log ', {LINE_PRICING_TIME}, case when l_returnflag = 'N' then '' else ' ' end,"
        " cast(l_orderkey as string), ' ', cast(l_partkey as string), ' ',"
        """ cast(l_linenumber as string), ' {"M":', cast(l_suppkey as string), '}"}')""",
    )


@query(
    "s6_api_pattern",
    f"""
    select {LINE_TIME.replace(" as string)", " as varchar)")} as datetime,
           '10.0.0.' || cast(l_linenumber as varchar) as ip_1,
           '10.0.1.' || cast(l_linenumber as varchar) as ip_2,
           case when l_returnflag = 'N' then null else cast(l_suppkey as int) end as driver_id
    from lineitem
    """,
)
def s6(t: Tables):
    return _log(
        t,
        "driver_api_access_gray",
        "lineitem",
        f"concat('log ', {LINE_TIME}, '  10.0.0.', cast(l_linenumber as string), '   -   10.0.1.',"
        " cast(l_linenumber as string), '   name_x   -   ',"
        " case when l_returnflag = 'N' then '' else cast(l_suppkey as string) end, '   rest')",
    )


@query(
    "s7_tsv",
    """
    select o_orderkey as id, case when o_orderstatus = 'F' then null
           else cast(o_custkey as int) end as "user", o_orderpriority as priority
    from orders where o_orderstatus <> 'P'
    """,
)
def s7(t: Tables):
    """Bad numbers are NULL, surplus fields are ignored, short lines are left out."""
    line = F.expr(
        "case o_orderstatus when 'P' then cast(o_orderkey as string)"
        " when 'F' then concat_ws('\t', o_orderkey, 'x', o_orderpriority)"
        " else concat_ws('\t', o_orderkey, o_custkey, o_orderpriority, 'surplus') end"
    )
    schema = fields("id:bigint user:int priority:string")
    return text.parse_tsv(t.orders.select(line.alias("value")), schema, on_short="skip")


@query(
    "s7_short_lines",
    "select cast(o_orderkey as varchar) as value from orders where o_orderstatus = 'P'",
)
def s7_short(t: Tables):
    line = F.expr(
        "case o_orderstatus when 'P' then cast(o_orderkey as string)"
        " else concat_ws('\t', o_orderkey, o_custkey, o_orderpriority) end"
    )
    schema = fields("id:bigint user:int priority:string")
    return text.short_lines(t.orders.select(line.alias("value")), schema)


@query(
    "s8_named_tsv",
    """
    select c_custkey as id, c_name as name, case when c_nationkey = 3 then null else c_acctbal end
           as balance, epoch_us(timestamp '2017-04-01') // 1000000 + c_custkey as created
    from customer
    """,
)
def s8(t: Tables):
    path = scratch_path(t.spark, "tsv")
    created = F.expr("date_format(timestamp_ntz'2017-04-01 00:00:00'"
                     " + make_dt_interval(0, 0, 0, c_custkey), 'yyyy-MM-dd HH:mm:ss')")  # fmt: skip
    balance = F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_acctbal").cast("string"))
    line = F.concat_ws("\t", F.col("c_custkey"), "c_name", balance, created)
    t.customer.select(line.alias("value")).write.text(path)
    schema = fields("id:bigint name:string balance:double created:timestamp")
    rows = text.read_tsv_named(t.spark, path, schema, dates=["created"])
    return rows.withColumn("created", epoch_of(F.col("created").cast("timestamp_ntz")))


@query(
    "s9_scan",
    "select l_orderkey, l_discount from lineitem where l_discount > 0.05e0",
)
def s9(t: Tables):
    lines = stored.read_parquet(t.spark, f"{t.folder}/lineitem.parquet")
    return lines.where(F.col("l_discount") > 0.05).select("l_orderkey", "l_discount")


def _partitioned_orders(t: Tables) -> str:
    path = scratch_path(t.spark, "ods")
    rows = service_order(t).select("service_order_id", "city", "update_time", "dt")
    writers.balanced(rows, "dt").write.partitionBy("dt").parquet(path)
    return path


@query(
    "s10_ods",
    f"""
    {with_views("service_order")}
    select service_order_id, city, update_time, dt from service_order
    where dt in ({DATES[1]}, {DATES[4]}) and city = 'bj'
    """,
)
def s10(t: Tables):
    return stored.read_ods(t.spark, _partitioned_orders(t), [DATES[1], DATES[4]], "bj")


@query(
    "s10_absent_day",
    f"""
    {with_views("service_order")}
    select service_order_id, city, update_time, dt, cast(null as varchar) as remark
    from service_order where dt = {DATES[1]}
    """,
)
def s10_absent(t: Tables):
    """One of two days is there, and one of the declared columns is in no file; a table of which
    no asked day is there has the columns and no rows."""
    schema = "service_order_id bigint, city string, update_time int, remark string, dt int"
    path = _partitioned_orders(t)
    none = stored.read_ods(t.spark, path, ["20990101"], schema=schema)
    return stored.read_ods(t.spark, path, [DATES[1], "20990101"], schema=schema).unionByName(none)


@query("s11_existing", "select c_custkey, c_name from customer")
def s11(t: Tables):
    """The table exists as a view; one that does not gives nothing."""
    t.customer.select("c_custkey", "c_name").createOrReplaceTempView("known_customers")
    if stored.read_existing(t.spark, "no_such_table") is not None:
        raise AssertionError("found a table that does not exist")
    return stored.read_existing(t.spark, "known_customers")


@query(
    "s13_days",
    f"""
    {with_views("service_order")}
    select service_order_id, dt, update_time from service_order
    """,
)
def s13(t: Tables):
    base = scratch_path(t.spark, "merged")
    rows = service_order(t).select("service_order_id", "dt", "update_time")
    for day in DATES:
        path = stored.merged_path(base, "bj", day)
        writers.write_overwrite(rows.where(F.col("dt") == int(day)), path)
    return stored.read_days(t.spark, base, "bj", DATES)


# -- sinks -------------------------------------------------------------------------------

_ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus from orders"


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")


@query("k1_replace_partition", f"select *, {DATES[0]} as dt from ({_ORDERS_SQL}) o")
def k1(t: Tables):
    """The second run replaces the first one's rows."""
    base = scratch_path(t.spark, "day")
    writers.write_partition(_orders(t).unionAll(_orders(t)), base, dt=int(DATES[0]))
    writers.write_partition(_orders(t), base, dt=int(DATES[0]))
    return t.spark.read.parquet(base)


@query(
    "k1_absent_day",
    f"""
    select user_id as service_order_id, cast(event_id as int) as operator_id, {DATES[0]} as dt
    from (select *, row_number() over (partition by user_id
              order by epoch_us(ts) // 1000000 desc, event_id desc) as rn
          from events where user_id is not null) r
    where rn = 1 and event_type <> 'error'
    """,
)
def k1_absent(t: Tables):
    """Both days are converted; then the second has no landed folder, and its rows go."""
    full, without, ods = (scratch_path(t.spark, n) for n in ("raw", "raw", "ods"))
    for day in DATES[:2]:
        _change_lines(t).write.text(f"{full}/dt={day}")
    _change_lines(t).write.text(f"{without}/dt={DATES[0]}")
    for raw in (full, without):
        for day in DATES[:2]:
            convert_log(t.spark, "service_order_ext", raw, ods, day)
    rows = stored.read_ods(t.spark, ods, DATES[:2], schema=ods_schema("service_order_ext"))
    return rows.select("service_order_id", "operator_id", "dt")


@query(
    "k2_replace_hours",
    f"select *, {DATES[0]} as dt, cast(o_orderkey % 24 as int) as hour from ({_ORDERS_SQL}) o",
)
def k2(t: Tables):
    base = scratch_path(t.spark, "hours")
    rows = _orders(t).withColumn("hour", F.expr("cast(o_orderkey % 24 as int)"))
    writers.write_partition(rows, base, by=["hour"], dt=int(DATES[0]))
    return t.spark.read.parquet(base)


@query("k3_replace_folder", _ORDERS_SQL)
def k3(t: Tables):
    path = scratch_path(t.spark, "folder")
    writers.write_overwrite(_orders(t), path)
    writers.write_overwrite(_orders(t), path)
    return t.spark.read.parquet(path)


@query("k4_repartitioned", _ORDERS_SQL)
def k4(t: Tables):
    path = scratch_path(t.spark, "even")
    writers.write_repartitioned(_orders(t), path, 8)
    return t.spark.read.parquet(path)


def _file_shares(t: Tables, path: str) -> tuple[int, int, int]:
    """Files of a folder, its rows, and the rows of the largest file."""
    each = t.spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return tuple(each.agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first())


@query("k4_even_files", "select cast(8 as bigint) as files, count(*) as rows, true as even from orders")
def k4_even(t: Tables):
    """How many files there are, and whether none holds much more than its share."""
    path = scratch_path(t.spark, "even")
    writers.write_repartitioned(_orders(t), path, 8)
    files, rows, most = _file_shares(t, path)
    return t.spark.createDataFrame([(files, rows, most * files <= 1.5 * rows)], "files bigint, rows bigint, even boolean")


@query(
    "k12_files_follow_bytes",
    "select count(*) as rows, 2 * count(*) as twice, true as several, true as doubled, true as even from lineitem",
)
def k12_bytes(t: Tables):
    """Twice the rows give about twice the files of the same size."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    found = []
    for df in (rows, rows.unionAll(rows)):
        path = scratch_path(t.spark, "sized")
        # Small parts, as the given tables are small: about 16 bytes of a row are shuffled.
        writers.write_sized(df, path, part_bytes=max(16 << 10, rows.count() * 2))
        found.append(_file_shares(t, path))
    (few, one, most), (many, two, _) = found
    several, doubled, even = few >= 4, 1.5 * few <= many <= 2.5 * few, most * few <= 2.0 * one
    kind = "rows bigint, twice bigint, several boolean, doubled boolean, even boolean"
    return t.spark.createDataFrame([(one, two, several, doubled, even)], kind)


def _through_table(t: Tables, rows: DataFrame, fmt: str) -> str:
    path = scratch_path(t.spark, "table")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writers.write_table(rows, name, fmt, path)
    return name


def _with_provider(t: Tables, name: str) -> DataFrame:
    """The table's rows with the format that the catalog has for it."""
    return t.spark.table(name).withColumn("provider", F.lit(writers.table_details(t.spark, name)["Provider"]))


@query("k5_orc_table", f"select *, 'orc' as provider from ({_ORDERS_SQL}) o")
def k5(t: Tables):
    return _with_provider(t, _through_table(t, _orders(t), "orc"))


@query("k6_named_table", f"select *, 'parquet' as provider from ({_ORDERS_SQL}) o")
def k6(t: Tables):
    return _with_provider(t, _through_table(t, _orders(t), "parquet"))


@query(
    "k8_keyed_upsert",
    f"""
    with kpi as ({KPI_SQL})
    select key, value, datetime from kpi
    union all
    select 'orders', printf('%.4f', cast(count(*) as double)), '0' from orders
    """,
)
def k8(t: Tables):
    """The job on a KPI table whose old rows have one key of their own and one that is replaced."""
    path = scratch_path(t.spark, "kpi")
    count = F.format_string("%.4f", F.count(F.lit(1)).cast("double"))
    old = t.orders.agg(count.alias("value")).select(
        F.explode(F.array(F.lit("orders"), F.lit("dispatch_count_all"))).alias("key"),
        F.lit("0").alias("datetime"),
        "value",
    )
    writers.write_overwrite(kpi_table(old), path)
    refresh_dispatch_kpi(t.spark, dispatch_info(t), path)
    return t.spark.read.parquet(path).select("key", "value", "datetime")


@query(
    "k10_add_partitions",
    f"""
    {with_views("service_order")}
    select dt, count(*) as rows from service_order group by dt
    """,
)
def k10(t: Tables):
    path = _partitioned_orders(t)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    columns = "service_order_id bigint, city string, update_time int, dt int"
    t.spark.sql(
        f"create table {name} ({columns}) using parquet partitioned by (dt) location '{path}'"
    )
    writers.add_partitions(t.spark, name)
    return t.spark.table(name).groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "k10_drop_and_find_again",
    f"""
    {with_views("service_order")}
    select dt, count(*) as rows, cast(0 as bigint) as while_dropped
    from service_order where dt <> {DATES[3]} group by dt
    """,
)
def k10_drop(t: Tables):
    """A day that is dropped from the catalog alone is found again; one whose files went is not."""
    path = _partitioned_orders(t)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    columns = "service_order_id bigint, city string, update_time int, dt int"
    t.spark.sql(f"create table {name} ({columns}) using parquet partitioned by (dt) location '{path}'")
    writers.add_partitions(t.spark, name)
    writers.drop_table_partition(t.spark, name, DATES[2])
    writers.drop_table_partition(t.spark, name, DATES[3], files=True)
    gone = F.col("dt").isin(int(DATES[2]), int(DATES[3]))
    dropped = t.spark.table(name).where(gone).count()
    writers.add_partitions(t.spark, name)
    found = t.spark.table(name).groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))
    return found.withColumn("while_dropped", F.lit(dropped).cast("bigint"))


@query(
    "k11_retention",
    f"""
    {with_views("service_order")}
    select dt, count(*) as rows from service_order where dt <> {DATES[2]} group by dt
    """,
)
def k11(t: Tables):
    path = _partitioned_orders(t)
    writers.drop_partition(t.spark, path, DATES[2])
    return t.spark.read.parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


@query("k12_few_files", _ORDERS_SQL)
def k12(t: Tables):
    path = scratch_path(t.spark, "few")
    writers.write_overwrite(_orders(t), path, files=20)
    return t.spark.read.parquet(path)


@query(
    "k13_hour_names",
    """
    select o_orderkey, 1 as hour from orders
    """,
)
def k13(t: Tables):
    """``hour=01`` and ``hour=1`` are one partition value."""
    base = scratch_path(t.spark, "named")
    keys = t.orders.select("o_orderkey", "o_orderstatus")
    keys.where("o_orderstatus = 'F'").drop("o_orderstatus").write.parquet(f"{base}/hour=01")
    keys.where("o_orderstatus <> 'F'").drop("o_orderstatus").write.parquet(f"{base}/hour=1")
    return t.spark.read.parquet(base)


# -- streams -----------------------------------------------------------------------------


def _landed(t: Tables, by_hour: bool) -> DataFrame:
    """Land half of the lines, then, from the same checkpoint, the other half."""
    source = scratch_path(t.spark, "topic")
    base, checkpoint = scratch_path(t.spark, "landed"), scratch_path(t.spark, "offsets")
    lines = t.events.select("event_type", F.to_json(F.struct("event_id", "props")).alias("value"))
    for part in ("event_type <= 'error'", "event_type > 'error'"):
        lines.where(part).select("value").write.mode("append").text(source)
        stream = stored.stream_topic(t.spark, "events", path=source)
        land_stream(stream, base, checkpoint, by_hour, available_now=True).awaitTermination()
    return t.spark.read.text(base)


_LINES_SQL = """
    select '{"event_id":' || cast(event_id as varchar) || ',"props":"'
           || replace(props, '"', chr(92) || '"') || '"}' as value
    from events
"""


@query("t1_land_by_day", _LINES_SQL)
def t1(t: Tables):
    return _landed(t, by_hour=False).select("value")


@query("t2_land_by_hour", _LINES_SQL)
def t2(t: Tables):
    rows = _landed(t, by_hour=True)
    return rows.where(F.col("hour").between(0, 23)).select("value")


@query("t3_timed_roll", _LINES_SQL)
def t3(t: Tables):
    """A query on a timer, which finds new files between its batches, is stopped and goes on."""
    source, base, checkpoint = (scratch_path(t.spark, n) for n in ("topic", "landed", "offsets"))
    lines = t.events.select("event_id", F.to_json(F.struct("event_id", "props")).alias("value"))
    t.spark.createDataFrame([], "value string").write.text(source)
    for runs in ((0, 1), (2, 3)):
        stream = stored.stream_topic(t.spark, "events", path=source)
        landing = land_stream(stream, base, checkpoint, roll="1 second")
        try:
            for part in runs:
                lines.where(F.col("event_id") % 4 == part).select("value").write.mode("append").text(source)
                landing.processAllAvailable()
        finally:
            landing.stop()
    return t.spark.read.text(base).select("value")


@query(
    "t4_late_versions",
    f"""
    with landed as (
        select user_id, event_id, event_type, epoch_us(ts) // 1000000 as changed,
               cast({DATES[0]} + event_id % 2 as int) as dt
        from events where user_id is not null
    ), of_day as (
        select *, row_number() over (partition by dt, user_id order by changed desc, event_id desc) as rn
        from landed
    ), newest as (
        select *, row_number() over (partition by user_id order by changed desc, event_id desc) as place
        from of_day where rn = 1 and event_type <> 'error'
    )
    select user_id as service_order_id, cast(event_id as int) as operator_id,
           cast(changed as int) as update_time, dt
    from newest where place = 1
    """,
)
def t4(t: Tables):
    """Half of the versions land on one day and half on the next, whatever their own time: for
    many ids the newer one is in the earlier folder."""
    source, landed, checkpoint, ods = (scratch_path(t.spark, n) for n in ("topic", "landed", "offsets", "ods"))
    for i, day in enumerate(DATES[:2]):
        _change_lines(t, F.col("event_id") % 2 == i).write.mode("append").text(source)
        noon = F.lit(MIDNIGHT + i * 86400 + 43200)
        stream = stored.stream_topic(t.spark, "changes", path=source)
        land_stream(stream, landed, checkpoint, available_now=True, arrived=noon).awaitTermination()
    for day in DATES[:2]:
        convert_log(t.spark, "service_order_ext", landed, ods, day)
    state = current_state(t.spark, "service_order_ext", ods, DATES[:2])
    return state.select("service_order_id", "operator_id", "update_time", "dt")


# -- jobs over files -----------------------------------------------------------------------

_CHANGE_SCHEMA = LOGS["service_order_ext"].schema


def _change_lines(t: Tables, where: Column | None = None) -> DataFrame:
    """Events as lines of a change log: the user is the id, errors delete it."""
    known = {
        "service_order_id": "cast(user_id as string)",
        "operator_id": "cast(event_id as string)",
        "predict_amount": "cast(value as string)",
        "estimate_snap": "props",
        "update_time": "cast(unix_date(cast(ts as date)) * 86400 + hour(ts) * 3600"
        " + minute(ts) * 60 + second(ts) as string)",
        "operation": "case when event_type = 'error' then 'DELETE' else 'UPDATE' end",
    }
    parts = [F.expr(known.get(n, f"'{text.NULL_TOKEN}'".replace("\\", "\\\\"))) for n, _ in _CHANGE_SCHEMA]
    events = t.events if where is None else t.events.where(where)
    return events.select(F.concat_ws(CONTROL_A, *parts).alias("value"))


_LATEST_EVENT_SQL = """
    select user_id as service_order_id, cast(event_id as int) as operator_id,
           value as predict_amount, props as estimate_snap
    from (select *, row_number() over (partition by user_id
              order by epoch_us(ts) // 1000000 desc, event_id desc) as rn from events) r
    where rn = 1 and event_type <> 'error'
"""


@query("c1_compact_change_log", _LATEST_EVENT_SQL)
def c1(t: Tables):
    raw, ods = scratch_path(t.spark, "raw"), scratch_path(t.spark, "ods")
    _change_lines(t).write.text(f"{raw}/dt={DATES[0]}")
    path = convert_log(t.spark, "service_order_ext", raw, ods, DATES[0])
    return t.spark.read.parquet(path).select(
        "service_order_id",
        "operator_id",
        F.col("predict_amount").cast("double").alias("predict_amount"),
        "estimate_snap",
    )


@query(
    "c2_convert_hourly_log",
    f"""
    select {LINE_TIME.replace(" as string)", " as varchar)")} as datetime,
           l_orderkey as service_order_id, l_suppkey as driver_id,
           l_discount as driver_bidding_rate, cast(l_partkey % 24 as int) as hour
    from lineitem where l_returnflag <> 'N'
    """,
)
def c2(t: Tables):
    """A day of an hourly log in one job; lines without an order id are dropped."""
    known = {
        "datetime": LINE_TIME,
        "service_order_id": "case when l_returnflag = 'N' then '' else cast(l_orderkey as string) end",
        "driver_id": "cast(l_suppkey as string)",
        "driver_bidding_rate": "cast(l_discount as string)",
    }
    schema = LOGS["dispatch_detail"].schema
    line = F.concat_ws(TWO_PIPES, *[F.expr(known.get(n, "''")) for n, _ in schema])
    raw, ods = scratch_path(t.spark, "raw"), scratch_path(t.spark, "ods")
    lines = t.lineitem.select(line.alias("value"), F.expr("l_partkey % 24").alias("hour"))
    lines.write.partitionBy("hour").text(f"{raw}/dt={DATES[0]}")
    path = convert_log(t.spark, "dispatch_detail", raw, ods, DATES[0])
    return t.spark.read.parquet(path).select(
        "datetime", "service_order_id", "driver_id", "driver_bidding_rate", "hour"
    )


@query(
    "c3_import_export",
    """
    select l_orderkey as service_order_id, cast(l_linenumber as int) as update_time,
           cast(min(l_partkey) as int) as operator_id
    from lineitem group by 1, 2
    """,
)
def c3(t: Tables):
    """Exports keep one row per id and version."""
    source = IMPORTS["fo_service_order_ext"]
    known = {
        "service_order_id": "cast(l_orderkey as string)",
        "update_time": "cast(l_linenumber as string)",
        "operator_id": "cast(l_partkey as string)",
        "dt": f"'{DATES[0]}'",
    }
    line = F.concat_ws("\t", *[F.expr(known.get(n, "''")) for n, _ in source.schema])
    rows = export_rows(t.lineitem.select(line.alias("value")), source, DATES[0])
    return rows.select("service_order_id", "update_time", "operator_id")


@query(
    "c12_devices",
    f"""
    select cast(c_custkey as varchar) as device_id, c_custkey as user_id, c_name as os_name,
           {DATES[0]} as dt
    from customer
    """,
)
def c12(t: Tables):
    path, target = scratch_path(t.spark, "devices"), scratch_path(t.spark, "device_table")
    line = "concat_ws('\t', c_custkey, c_custkey, '', '', '', '', '', '', '', '', '', '', c_name, '', '0')"
    t.customer.selectExpr(f"{line} as value").write.text(path)
    writers.write_overwrite(devices(t.spark, path, DATES[0]), target)
    return t.spark.read.parquet(target).select("device_id", "user_id", "os_name", "dt")


def _risk_lines(t: Tables, flag: str, city: str) -> str:
    path = scratch_path(t.spark, "risk")
    line = (
        f"concat_ws('\t', o_orderkey, '{city}', o_custkey, '', o_totalprice, '', '', '', '', '',"
        f" '', '', '', '', '', {flag})"
    )
    t.orders.selectExpr(f"{line} as value").write.text(path)
    return path


@query(
    "c13_risk_orders",
    f"""
    select o_orderkey as service_order_id,
           case when o_orderstatus = 'O' then 'new' else 'old' end as city,
           o_totalprice as price,
           case when o_orderstatus = 'O' then {DATES[1]} else {DATES[0]} end as dt
    from orders where o_orderstatus <> 'P'
    """,
)
def c13(t: Tables):
    """The job on two days: the second's rows replace those of the first with the same order."""
    first = _risk_lines(t, "case when o_orderstatus = 'P' then 'F' else 'T' end", "old")
    second = _risk_lines(t, "case when o_orderstatus = 'O' then 'T' else 'F' end", "new")
    target = scratch_path(t.spark, "risk_table")
    for path, day in ((first, DATES[0]), (second, DATES[1])):
        update_risk_orders(t.spark, path, day, target)
    return t.spark.read.parquet(target).select("service_order_id", "city", "price", "dt")


@query(
    "k8_only_touched_buckets",
    """
    select o_orderkey, case when o_orderkey % 500 = 3 then 'new' else o_orderstatus end as status,
           false as rewritten_elsewhere
    from orders
    """,
)
def k8_buckets(t: Tables):
    """A delta of a few keys; files of buckets without one of them stay as they are."""
    path = scratch_path(t.spark, "merged_orders")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    writers.merge_path(t.spark, rows, path, ["o_orderkey"], buckets=64)
    before = set(t.spark.read.parquet(path).inputFiles())
    few = rows.where(F.col("o_orderkey") % 500 == 3).withColumn("status", F.lit("new"))
    touched = writers.merge_path(t.spark, few, path, ["o_orderkey"])
    after = set(t.spark.read.parquet(path).inputFiles())
    buckets = {int(name.rsplit("/", 1)[1][1:6]) for name in before ^ after}
    return t.spark.read.parquet(path).withColumn("rewritten_elsewhere", F.lit(not buckets <= set(touched)))
