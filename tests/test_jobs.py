"""The dispatch jobs on a few orders, from table folders to the training table."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cabflow.operators.aggregates import RowCounts
from cabflow.plans import daily
from cabflow.plans.dispatch import dispatch_info_extract, dispatch_rounds, numbered_batches, numbered_rounds
from cabflow.plans.orders import order_base
from cabflow.plans.pricing import pricing
from cabflow.plans.training import training_table
from cabflow.queries import domain
from cabflow.queries.base import Tables
from cabflow.schemas import LOGS
from cabflow.sinks.writers import staged_by

DAY, CITY = "20170401", "bj"
MIDNIGHT = 1490976000


def frame(spark, name, rows, **extra):
    """Rows of a table by column name; columns that are not given are NULL."""
    schema = [*LOGS[name].schema, ("dt", "int")] + list(extra.items())
    data = [tuple(row.get(n, int(DAY) if n == "dt" else None) for n, _ in schema) for row in rows]
    wide = {"decimal(8,2)": "double", "decimal(10,2)": "double"}
    loose = ", ".join(f"`{n}` {wide.get(t, t)}" for n, t in schema)
    df = spark.createDataFrame(data, loose)
    return df.selectExpr(*[f"cast(`{n}` as {t}) as `{n}`" for n, t in schema])


def order(key, **known):
    base = {
        "service_order_id": key,
        "city": CITY,
        "status": 7,
        "user_id": 100 + key,
        "create_time": MIDNIGHT + 600,
        "update_time": MIDNIGHT + 700,
        "expect_start_latitude": 39.9,
        "expect_start_longitude": 116.4,
    }
    return base | known


def ext(key, **known):
    snap = json.dumps({"time_length": 9, "distance": 12, "estimate_price": "33"})
    return {"service_order_id": key, "update_time": 1, "user_type": 2, "estimate_snap": snap} | known


def info(key, number, **known):
    city = known.pop("template_city", CITY)
    template = {
        "city": city,
        "code": "normal",
        "isRushHour": 0,
        "remark": "r",
        "dispatchParams": {"bATCH_DRIVER_COUNT": 40, "mAX_RANGE": 50000},
    }
    base = {
        "datetime": "2017-04-01 10:00:00",
        "service_order_id": key,
        "round": number,
        "batch": 1,
        "user_id": 100 + key,
        "city": CITY,
        "bidding_id": 900 + key,
        "decision_type": 1,
        "flag": 1024,
        "can_dispatch_count": 4,
        "dispatch_count": 3,
        "response_count": 1,
        "accept_count": 0,
        "decision_driver_id": 0,
        "add_price_info": json.dumps({"dsb": 0.1, "sb": "0.2", "dep": 50}),
        "template_snapshot": json.dumps(template),
    }
    return base | known


def detail(key, number, driver, **known):
    base = {
        "datetime": "2017-04-01 10:00:05",
        "service_order_id": key,
        "round": number,
        "batch": 1,
        "driver_id": driver,
        "city": CITY,
        "dispatch_time": MIDNIGHT + 36000,
        "hour": 10,
    }
    return base | known


def escaped(payload):
    return json.dumps(payload).replace('"', '\\"')


def round_log(bidding, number, payload, order_id=1):
    return {
        "datetime": "2017-04-01_10:00:00",
        "order_id": order_id,
        "bidding_id": bidding,
        "round": number,
        "data": payload if isinstance(payload, str) else escaped(payload),
    }


@pytest.fixture(scope="module")
def tables(spark):
    orders = [
        order(1),
        order(1, update_time=MIDNIGHT + 900, car_type="newer"),
        order(2),
        order(3),
        order(4, status=5),
        order(5, create_time=MIDNIGHT - 1),
        order(6, city="sh"),
        order(7),
        order(8),
    ]
    extensions = [
        ext(1, update_time=2),
        ext(1, user_type=9),
        ext(2),
        ext(3, estimate_snap="broken"),
        ext(7),
        ext(8),
    ]
    rounds = [
        info(1, 1, decision_time=None, accept_count=1),
        info(1, 2, decision_time=MIDNIGHT + 36100, accept_count=1, decision_driver_id=55),
        info(1, 3, decision_time=MIDNIGHT + 36050, decision_type=2),
        info(2, 1, decision_time=0, can_dispatch_count=None, flag=512),
        info(7, 1, template_city="sh"),
        info(8, 1, bidding_id=0),
    ]
    details = [
        detail(1, 1, 54, driver_bidding_rate=0.3, accept_status=1, response_time=7, decision_result=1),
        detail(1, 1, 55, driver_bidding_rate=0.1, accept_status=0, route_distance=10),
        detail(1, 2, 55, driver_bidding_rate=0.2, accept_status=1, response_time=None, decision_result=2),
        detail(2, 1, 56),
        detail(8, 1, 57, driver_bidding_rate=0.4),
    ]
    pre = [
        {
            "datetime": "2017-04-01_09:59:00",
            "bidding_id": bidding,
            "data": escaped({"productTypeId": 17, "availableDriverNum": 4, "M": 0.16}),
        }
        for bidding in (901, 901, 902, 999)
    ]
    drivers = {"54": {"totalMagnification": 0.1}, "55": {"totalMagnification": "0.3"}}
    system = [
        round_log(901, 1, {"totalMagnification": 0.5}),
        round_log(901, 2, {"totalMagnification": "0.7"}),
        round_log(901, 3, {"totalMagnification": 0.9}, order_id=None),
    ]
    personal = [round_log(901, 4, {"driverData": drivers})]
    return {
        "service_order": frame(spark, "service_order", orders),
        "service_order_ext": frame(spark, "service_order_ext", extensions),
        "dispatch_info": frame(spark, "dispatch_info", rounds),
        "dispatch_detail": frame(spark, "dispatch_detail", details, hour="int"),
        "pre_dispatch": frame(spark, "pre_dispatch", pre),
        "system_dispatch": frame(spark, "system_dispatch", system),
        "personal_dispatch": frame(spark, "personal_dispatch", personal),
    }


def test_order_extract(tables):
    got = order_base(tables["service_order"], tables["service_order_ext"], [DAY], CITY)
    rows = {r.service_order_id: r for r in got.collect()}
    assert sorted(rows) == [1, 2, 7, 8]
    assert rows[1].car_type == "newer" and rows[1].user_type == 2
    assert (rows[2].estimate_distance, rows[2].estimate_price) == ("12", "33")
    assert len(got.columns) == 42


def test_dispatch_rounds(tables):
    got = dispatch_info_extract(tables["dispatch_info"], [DAY], CITY)
    rows = {r.service_order_id: r for r in got.collect()}
    # The template of order 7 is of another city.
    assert sorted(rows) == [1, 2, 8]
    one = rows[1]
    assert one.sum_batch == 2 and one.bidding_id == 901 and one.batch_driver_count == "40"
    assert (one.max_round, one.avg_can_dispatch, one.sum_can_dispatch) == (3, 4.0, 12)
    # A missing decision time comes first in time order.
    assert (one.first_accept_round, one.first_accept_time) == (1, None)
    assert (one.first_decision_round, one.first_decision_driver_id) == (2, 55)
    # The round without a decision time ends when it was logged: 10:00:00.
    assert (one.final_round, one.final_decision_time) == (2, MIDNIGHT + 36100)
    assert (one.final_driver_bidding_rate, one.final_user_bidding_rate) == (0.1, 0.2)
    assert rows[2].avg_can_dispatch is None
    assert rows[2].final_decision_time == MIDNIGHT + 36000
    assert len(got.columns) == 49


def test_counting_apart_changes_no_number(tables):
    rounds = dispatch_rounds(tables["dispatch_info"], [DAY], CITY)
    numbers = {(r.service_order_id, r.round, r.acc_batch) for r in numbered_rounds(rounds).collect()}
    assert numbers == {(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 1, 1), (8, 1, 1)}


def prices(tables):
    names = ("pre_dispatch", "system_dispatch", "personal_dispatch", "dispatch_info")
    return pricing(*[tables[n] for n in names], [DAY], CITY)


def test_pricing(tables):
    got = sorted(
        (r.bidding_id, r.end_bidding_round, r.end_min_bidding_rate, r.end_max_bidding_rate)
        for r in prices(tables).where("bidding_id = 901").collect()
    )
    # Both logs know the id: two rows, with the lowest and highest in their places.
    assert got == [(901, 2, 0.7, 0.7), (901, 4, 0.1, 0.3)]
    other = prices(tables).where("bidding_id <> 901").collect()
    assert [(r.bidding_id, r.end_bidding_round) for r in other] == [(902, None)]
    assert other[0].pre_availableDriverNum == 4.0
    assert other[0].datetime == MIDNIGHT + 10 * 3600 - 60


def test_rounds_of_one_time_are_told_apart_by_rates(tables, spark):
    """Not by the text of the payload, in which 9 comes after 10 and the name of a driver decides."""
    offers = [{"b": 0.1, "a": 0.2}, {"a": 0.3, "b": 0.3}, {"z": 0.3, "y": 0.2}]
    drivers = [{"driverData": {n: {"totalMagnification": r} for n, r in o.items()}} for o in offers]
    system = [round_log(901, 5, {"totalMagnification": r}) for r in (9, 10, None)]
    logs = {
        "system_dispatch": frame(spark, "system_dispatch", [round_log(901, 4, {"totalMagnification": 99}), *system]),
        "personal_dispatch": frame(spark, "personal_dispatch", [round_log(901, 6, d) for d in drivers]),
    }
    got = sorted(
        (r.end_bidding_round, r.end_min_bidding_rate, r.end_max_bidding_rate)
        for r in prices(tables | logs).where("bidding_id = 901").collect()
    )
    assert got == [(5, 10.0, 10.0), (6, 0.3, 0.3)]


def test_pricing_reads_the_rounds_once(spark, tables, tmp_path):
    path = str(tmp_path / "info")
    tables["dispatch_info"].write.parquet(path)
    names = ("pre_dispatch", "system_dispatch", "personal_dispatch")
    got = pricing(*[tables[n] for n in names], spark.read.parquet(path), [DAY], CITY)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    # What is left of the rounds is the written ids.
    assert path not in plan and plan.count("pricing_ids-") >= 3


def test_merge(tables):
    rows = daily.merge_tables(tables, [DAY], CITY).collect()
    by_order = {}
    for r in rows:
        by_order.setdefault(r.service_order_id, []).append(r)
    # Order 8 was offered a surcharge that no pricing log knows.  For orders 2 and 7 no
    # rate is known at all, and "unknown" is not "no contradiction".
    assert {key: len(found) for key, found in by_order.items()} == {1: 2}
    one = by_order[1][0]
    assert one.decision_type_flag == "system_decision"
    assert (one.first_accept_round_ext, one.first_accept_time_ext) == (2, None)
    assert (one.first_decision_round_ext, one.first_decision_max_bidding_rate) == (2, 0.2)
    assert (one.final_round_ext, one.final_acc_batch_ext) == (2, 2)
    assert len(daily.merge_tables(tables).columns) == 154


def test_training(spark, tables):
    merged = daily.merge_tables(tables, [DAY], CITY)
    profile = spark.createDataFrame([(101, 3)], "uid bigint, user_order_count bigint")
    rows = training_table(merged, profile).collect()
    assert len(rows) == 2
    assert {r.label for r in rows} == {"bidding_decision_ok"}
    assert {r.bidding_rate_adjust for r in rows} == {0.1}
    assert {(r.abs_demand, r.relative_supply) for r in rows} == {(2, 4 / 3)}
    assert {(r.geo_order_count, r.geo_bidding_ok_pct) for r in rows} == {(2, 1.0)}
    assert {r.user_order_count for r in rows} == {3}
    assert training_table(merged, profile, fan_out="order").count() == 4


def test_files_to_training_table(spark, tables, tmp_path):
    ods, merged = str(tmp_path / "ods"), str(tmp_path / "merged")
    for name, df in tables.items():
        df.write.partitionBy("dt").parquet(f"{ods}/{name}")
    for _ in range(2):
        done = daily.prepare_day(spark, ods, merged, CITY, DAY)
    assert done.rows == {"orders": 4, "dispatch": 3, "candidates": 3, "pricing": 3, "merged": 2}
    # A day of which no table has a folder gives no rows; broken files of it are not opened.
    none = daily.prepare_day(spark, ods, merged, CITY, "20990101")
    assert set(none.rows.values()) == {0} and spark.read.parquet(none.path).count() == 0
    for _ in range(2):
        daily.build_training(
            spark, ods, merged, CITY, [DAY], "bidding_training", path=str(tmp_path / "training")
        )
    got = spark.table("bidding_training")
    assert got.count() == 2 and len(got.columns) == 177
    assert got.select("user_order_count").distinct().first()[0] == 1
    daily.write_profile(spark, ods, CITY, [DAY], "profile_bj", path=str(tmp_path / "profile"))
    users = {r.uid: r for r in spark.table("profile_bj").collect()}
    assert sorted(users) == [101, 102, 107, 108]
    # The profile goes by the city of the table, so order 7 counts.
    assert users[101].user_mean_wait_time == 100
    assert users[108].user_bidding_accept_flag == 0


def test_one_hot_order_is_summarised_right(spark):
    """A third of all rounds has one order id."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("bigint").alias("service_order_id"),
        (F.col("id") % 5).cast("tinyint").alias("round"),
        F.lit(1).cast("tinyint").alias("batch"),
        F.col("id").alias("datetime"),
        F.col("id").alias("v"),
    )
    got = numbered_rounds(rows).where("service_order_id = 1")
    numbers = [r.acc_batch for r in got.orderBy("round", "datetime").collect()]
    assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) >= 1000


def shuffled(df):
    """Columns of each shuffle in the plan as it stands before it is run."""
    found, nodes = [], [df._jdf.queryExecution().executedPlan().initialPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Exchange":
            found.append(node.output().size())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture
def by_sort(spark):
    """Joins of large tables: nothing is small enough to be sent to all tasks unasked."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merged_orders_are_cut_to_what_is_kept(spark, monkeypatch):
    """Rounds and candidates of other orders are left out first, and the result is the same."""
    seen, extract, base = {}, daily.dispatch_info_extract, daily.order_base
    monkeypatch.setattr(daily, "dispatch_info_extract", lambda info, *a: seen.update(info=info) or extract(info, *a))
    monkeypatch.setattr(daily, "order_base", lambda rows, *a: seen.update(orders=rows) or base(rows, *a))
    tables = domain.tables(Tables(spark, "/root/testdata/sf0.001"))
    merged = daily.merge_tables(tables, domain.DATES)
    kept = base(tables["service_order"], tables["service_order_ext"], domain.DATES).count()
    assert kept <= seen["orders"].count() < 1.2 * kept
    rounds, every = seen["info"].count(), tables["dispatch_info"].count()
    assert rounds < 0.7 * every
    whole = daily.merge_tables(tables, domain.DATES, counts=RowCounts())
    assert whole.columns == merged.columns and merged.count() > 100
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, whole.collect()))


def test_merged_orders_are_not_shuffled_by_pricing_id(tables, by_sort):
    merged = daily.merge_tables(tables, [DAY], CITY)
    assert len(merged.columns) == 154
    assert 30 < max(shuffled(merged)) < 60


def test_a_dropped_order_says_who_decided(spark, tables):
    """The pricing id of order 2 is decided by drivers only in a round of an order that is left out."""
    drivers = escaped({"driverData": {"54": {"totalMagnification": 0.1}}})
    more = {
        "dispatch_info": frame(spark, "dispatch_info", [info(2, 1), info(4, 1, bidding_id=902, decision_type=2)]),
        "personal_dispatch": frame(spark, "personal_dispatch", [round_log(902, 4, drivers)]),
    }
    # Without a template city order 4 is of the same city; it is not finished.
    rows = daily.merge_tables(tables | more, [DAY]).where("service_order_id = 2").collect()
    assert [(r.end_bidding_round, r.end_max_bidding_rate) for r in rows] == [(4, 0.1)]


def test_training_features_come_to_the_wide_rows(spark, tables, by_sort):
    merged = staged_by(spark, daily.merge_tables(tables, [DAY], CITY), "merged", "service_order_id")
    assert spark.catalog.listTables() == [] or all("merged_" not in t.name for t in spark.catalog.listTables())
    assert shuffled(merged.groupBy("service_order_id").count()) == []
    profile = spark.createDataFrame([(101, 3)], "uid bigint, user_order_count bigint")
    training = training_table(merged, profile)
    assert max(shuffled(training)) < 20
    assert [(r.abs_demand, r.user_order_count) for r in training.collect()] == [(2, 3)] * 2


@pytest.mark.parametrize("drivers, shuffles", [(1, 1), (4, 2)])
def test_candidates_are_shuffled_once_if_batches_are_small(spark, drivers, shuffles):
    details = [
        detail(key, number, driver, accept_status=1, route_distance=driver)
        for key in (1, 2, 3)
        for number in (1, 2)
        for driver in range(drivers)
    ]
    batches = numbered_batches(frame(spark, "dispatch_detail", details, hour="int"))
    assert len(shuffled(batches)) == shuffles
    got = sorted((r.service_order_id, r.round, r.acc_batch, r.accept_count, r.max_route_distance) for r in batches.collect())
    assert got == [(k, n, n, drivers, drivers - 1) for k in (1, 2, 3) for n in (1, 2)]
