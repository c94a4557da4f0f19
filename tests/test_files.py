"""Readers, writers, log conversion, imports and landing through files."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from cabflow.operators.aggregates import supply_demand
from cabflow.plans import imports, kpi, logs
from cabflow.schemas import CONTROL_A, IMPORTS, LOGS, fields, names, ods_schema
from cabflow.sinks import writers
from cabflow.sources import tables, text
from cabflow.streaming import cells
from cabflow.streaming.landing import LandedLines, land_stream, with_arrival


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf8") as f:
        f.write(content)


def line_of(name, **known):
    return CONTROL_A.join(known.get(n, r"\N") for n in names(LOGS[name].schema))


def test_delimited(spark):
    schema = fields("a:int b:string c:double")
    df = lines(spark, "1||x||0.5", r"\N||||y", '2||"q"', "3||{\"k\": 1}||1||rest")
    assert tuples(text.parse_delimited(df, schema, "||")) == sorted(
        [(1, "x", 0.5), (None, "", None), (2, '"q"', None), (3, '{"k": 1}', 1.0)], key=repr
    )


def test_patterns(spark):
    good = r'x 2017-04-09_23:59:57 - 123 - {\"M\":0.16}"}'
    df = lines(spark, good, good.replace("123", ""), good + "tail", "", "\u0001\u0002" + good)
    pre = text.parse_pattern(df, LOGS["pre_dispatch"].pattern, LOGS["pre_dispatch"].schema)
    stamp, data = "2017-04-09_23:59:57", r'{\"M\":0.16}'
    assert [tuple(r) for r in pre.collect()] == [
        (stamp, 123, data),
        (stamp, None, data),
        (None, None, None),
        (None, None, None),
        (stamp, 123, data),
    ]
    rounds = lines(spark, r'x 2017-04-09_23:59:56 1001 2001 1 {\"M\":0.56}"}')
    got = logs.typed_log(rounds, "system_dispatch").first()
    assert tuple(got) == ("2017-04-09_23:59:56", 1001, 2001, 1, r'{\"M\":0.56}')
    access = lines(spark, 'a [t] TAG /path {"a":1} 12.5 - ok {"b":2} z', "other")
    got = logs.typed_log(access, "bidding_access")
    assert got.columns == ["timestamp", "tag", "operation", "request", "result"]
    assert tuples(got) == [("t", "TAG", "/path", '{"a":1}', '{"b":2}')]
    api = lines(spark, "p 2017-04-09 23:59:57  1.2.3.4   -   5.6.7.8   name   -   42   x")
    got = logs.typed_log(api, "driver_api_access_gray")
    assert tuples(got) == [("2017-04-09 23:59:57", "1.2.3.4", "5.6.7.8", 42)]


def test_tsv(spark):
    schema = fields("a:int b:string")
    df = lines(spark, "1\tx", "bad\ty\tsurplus", "short")
    assert tuples(text.parse_tsv(df, schema, on_short="skip")) == [(1, "x"), (None, "y")]
    assert tuples(text.short_lines(df, schema)) == [("short",)]
    with pytest.raises(Exception, match="too few fields"):
        text.parse_tsv(df, schema).collect()


def test_change_log_job(spark, tmp_path):
    raw, ods = str(tmp_path / "raw"), str(tmp_path / "ods")

    def change(key, time, op, city="bj"):
        return line_of("service_order", service_order_id=key, update_time=time, operation=op, city=city)

    write(
        f"{raw}/dt=20170401",
        "a.log",
        "\n".join(
            [
                change("1", "10", "INSERT"),
                change("1", "20", "UPDATE", "sh"),
                change("2", "10", "INSERT"),
                change("2", "20", "DELETE"),
                change("x", "10", "INSERT"),
                "broken",
            ]
        ),
    )
    logs.convert_log(spark, "service_order", raw, ods, "20170401")
    logs.convert_log(spark, "service_order", raw, ods, "20170401")
    got = tables.read_ods(spark, ods, ["20170401"])
    assert tuples(got.select("service_order_id", "city", "update_time", "dt")) == [
        (1, "sh", 20, 20170401)
    ]
    # A day whose log is now empty clears the partition.
    write(f"{raw}/dt=20170401", "a.log", "")
    logs.convert_log(spark, "service_order", raw, ods, "20170401")
    assert spark.read.schema(got.schema).parquet(f"{ods}/dt=20170401").count() == 0


def test_hourly_log_job(spark, tmp_path):
    raw, ods = str(tmp_path / "raw"), str(tmp_path / "ods")
    schema = names(LOGS["dispatch_detail"].schema)

    def line(order):
        known = {"service_order_id": order, "driver_id": "7"}
        return "||".join(known.get(n, "") for n in schema)

    write(f"{raw}/dt=20170401/hour=01", "a.log", line("1"))
    write(f"{raw}/dt=20170401/hour=1", "b.log", line("2"))
    write(f"{raw}/dt=20170401/hour=13", "c.log", line("3") + "\n" + line(""))
    logs.convert_log(spark, "dispatch_detail", raw, ods, "20170401")
    got = spark.read.parquet(ods).select("service_order_id", "hour", "dt")
    want = [(1, 1, 20170401), (2, 1, 20170401), (3, 13, 20170401)]
    assert tuples(got) == want
    logs.convert_log(spark, "dispatch_detail", raw, ods, "20170401", hour=1)
    assert tuples(spark.read.parquet(ods).select("service_order_id", "hour", "dt")) == want


def test_import_job(spark, tmp_path):
    folder, base = str(tmp_path / "tsv"), str(tmp_path / "base")
    schema = IMPORTS["fo_service_order"].schema

    def line(key, time, day):
        known = {"service_order_id": key, "update_time": time, "dt": day}
        return "\t".join(known.get(n, "") for n in names(schema))

    content = [
        line("1", "10", "20170401"),
        line("1", "10", "2017040112"),
        line("1", "20", "20170401"),
        line("2", "x", "20170331"),
    ]
    write(folder, "fo_service_order_20170401.tsv", "\n".join(content))
    old = spark.range(1)
    for day in ("20170302", "20170301", "20170303"):
        old.write.parquet(f"{base}/dt={day}")
    imports.import_export(spark, "fo_service_order", folder, base, "20170401")
    got = spark.read.parquet(f"{base}/dt=20170401").select("service_order_id", "update_time")
    assert tuples(got) == [(1, 10), (1, 20)]
    assert sorted(os.listdir(base)) == ["dt=20170301", "dt=20170303", "dt=20170401"]
    writers.drop_partition(spark, base, "20170303", older_than=True)
    assert sorted(os.listdir(base)) == ["dt=20170401"]


def test_import_of_an_absent_export(spark, tmp_path):
    folder, base = str(tmp_path / "tsv"), str(tmp_path / "base")
    schema = IMPORTS["ods_service_order"].schema
    row = "\t".join("20170401" if n == "dt" else "" for n in names(schema))
    write(folder, "ods_service_order_20170401.tsv", "\n".join([row] * 500))
    imports.import_export(spark, "ods_service_order", folder, base, "20170401", part_bytes=16 << 10)
    assert spark.read.parquet(f"{base}/dt=20170401").count() == 500
    with pytest.raises(Exception, match="20170402"):
        imports.import_export(spark, "ods_service_order", folder, base, "20170402")
    os.rename(f"{folder}/ods_service_order_20170401.tsv", f"{folder}/elsewhere.tsv")
    imports.import_export(spark, "ods_service_order", folder, base, "20170401", on_absent="clear")
    assert spark.read.parquet(f"{base}/dt=20170401").count() == 0
    with pytest.raises(ValueError, match="on_absent"):
        imports.import_export(spark, "ods_service_order", folder, base, "20170401", on_absent="x")


def test_device_job(spark, tmp_path):
    write(tmp_path, "d.tsv", "d1\t7\t1\t0\t5\t1.0\tos\t9\tm\tt\ts\tf\tn\ta\t0\nd2\t\t\t\t\t\t\t\t\t\t\t\t\t\t0\n")
    target = str(tmp_path / "devices")
    for _ in range(2):
        imports.refresh_devices(spark, str(tmp_path / "d.tsv"), "20170401", target)
    got = spark.read.parquet(target).select("device_id", "user_id", "os_name", "dt")
    assert tuples(got) == [("d1", 7, "n", 20170401), ("d2", None, None, 20170401)]


def risk_line(key, city, flag):
    return f"{key}\t{city}" + "\t" * 3 + "\t2017-04-01 10:00:00" + "\t" * 10 + flag


def test_risk_order_job(spark, tmp_path):
    target = str(tmp_path / "risk")
    days = {
        "20170401": [risk_line(1, "a", "T"), risk_line(2, "a", "T"), risk_line(3, "a", "F")],
        "20170402": [risk_line(2, "b", "T"), risk_line(4, "b", "T")],
    }
    for day, content in days.items():
        write(tmp_path, f"{day}.txt", "\n".join(content))
        for _ in range(2):
            imports.update_risk_orders(spark, str(tmp_path / f"{day}.txt"), day, target)
    got = spark.read.parquet(target)
    assert tuples(got.select("service_order_id", "city", "dt")) == [
        (1, "a", 20170401), (2, "b", 20170402), (4, "b", 20170402)
    ]
    assert got.where(F.col("create_time").isNull()).count() == 0
    imports.update_risk_orders(spark, str(tmp_path / "20170402.txt"), "20170402", target, keep_days=1)
    assert {r.service_order_id for r in spark.read.parquet(target).collect()} == {2, 4}


def test_kpi_job(spark, tmp_path):
    path = str(tmp_path / "kpi")
    schema = "service_order_id bigint, bidding_id bigint, decision_driver_id bigint"
    for orders in ([(1, 9, 5)], [(1, 9, 5), (2, 9, 0)]):
        kpi.refresh_dispatch_kpi(spark, spark.createDataFrame(orders, schema), path)
    got = spark.read.parquet(path)
    assert got.columns == ["key", "datetime", "value", "update_time", "ext"]
    assert {(r.key, r.value) for r in got.collect()} == {
        ("dispatch_succ_rate", "0.5000"),
        ("dispatch_count_succ", "1.0000"),
        ("dispatch_count_all", "2.0000"),
    }


def test_only_the_asked_days_are_read(spark, tmp_path):
    base = str(tmp_path / "ods")
    spark.range(30).selectExpr("id", "20170401 + id % 3 as dt", "'bj' as city").write.partitionBy(
        "dt"
    ).parquet(base)
    got = tables.read_ods(spark, base, ["20170402"], "bj")
    assert got.count() == 10
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan or "PartitionFilters: [dt" in plan
    assert "EqualTo(city,bj)" in plan


def test_a_broken_file_of_another_day_is_not_opened(spark, tmp_path):
    base = str(tmp_path / "ods")
    spark.range(9).selectExpr("id", "'bj' as city").write.parquet(f"{base}/dt=20170402")
    write(f"{base}/dt=20170401", "part-0.parquet", "this is no Parquet file")
    schema = "id long, city string, added string, dt int"
    for given in (None, schema):
        got = tables.read_ods(spark, base, ["20170402", "20990101"], "bj", given)
        assert got.count() == 9
    assert got.columns == ["id", "city", "added", "dt"] and got.where("added is not null").count() == 0
    with pytest.raises(Exception, match="20170401|Parquet"):
        tables.read_ods(spark, base, ["20170401"], schema=schema).collect()
    none = tables.read_ods(spark, base, ["20990101"], schema=schema)
    assert none.count() == 0 and none.columns == got.columns
    with pytest.raises(FileNotFoundError, match="20990101"):
        tables.read_ods(spark, base, ["20990101"])


@pytest.mark.parametrize("name", sorted(LOGS))
def test_declared_columns_are_those_that_are_written(spark, name):
    empty = logs.raw_lines(spark, name, "/no/such/folder", "20170401")
    rows = logs.typed_log(empty, name).withColumn("dt", F.lit(1))
    declared = spark.createDataFrame([], ods_schema(name)).schema
    assert {(f.name, f.dataType.simpleString()) for f in rows.schema} == {
        (f.name, f.dataType.simpleString()) for f in declared
    }


def test_an_absent_day_clears_its_partition(spark, tmp_path):
    raw, ods = str(tmp_path / "raw"), str(tmp_path / "ods")
    for name, line in (
        ("service_order", line_of("service_order", service_order_id="1", update_time="1", operation="UPDATE")),
        ("dispatch_detail", "||".join({"service_order_id": "1"}.get(n, "") for n in names(LOGS["dispatch_detail"].schema))),
    ):
        hour = "/hour=3" if LOGS[name].by_hour else ""
        for day in ("20170401", "20170402"):
            write(f"{raw}/{name}/dt={day}{hour}", "a.log", line)
            logs.convert_log(spark, name, f"{raw}/{name}", f"{ods}/{name}", day)
        read = lambda: tables.read_ods(spark, f"{ods}/{name}", None, schema=ods_schema(name))  # noqa: B023, E731
        assert read().count() == 2
        logs.convert_log(spark, name, f"{raw}/nothing", f"{ods}/{name}", "20170402")
        assert [r.dt for r in read().collect()] == [20170401]
        # Hours of a day whose folder is there but empty.
        os.makedirs(f"{raw}/{name}/dt=20170403", exist_ok=True)
        logs.convert_log(spark, name, f"{raw}/{name}", f"{ods}/{name}", "20170403")
        assert read().count() == 1


def _merged(spark, path):
    return tuples(spark.read.parquet(path))


def test_merge_leaves_untouched_files(spark, tmp_path):
    path = str(tmp_path / "merged")
    rows = spark.range(200).selectExpr("id as k", "'old' as v", "cast(id % 3 as int) as dt")
    assert writers.merge_path(spark, rows, path, ["k"], buckets=16) == list(range(16))
    before = {n: os.path.getmtime(f"{path}/{n}") for n in os.listdir(path) if n.startswith("b")}
    delta = spark.createDataFrame([(5, "new", 9), (500, "new", 9)], "k long, v string, dt int")
    touched = writers.merge_path(spark, delta, path, ["k"])
    assert 1 <= len(touched) <= 2
    after = {n: os.path.getmtime(f"{path}/{n}") for n in os.listdir(path) if n.startswith("b")}
    kept = {n: t for n, t in before.items() if int(n[1:6]) not in touched}
    assert len(kept) >= 12 and kept.items() <= after.items()
    assert all(int(n[1:6]) in touched for n in set(before) ^ set(after))
    want = sorted([(k, "old", k % 3) for k in range(200) if k != 5] + [(5, "new", 9), (500, "new", 9)], key=repr)
    assert _merged(spark, path) == want
    # The same delta again changes no row, an empty one nothing at all.
    writers.merge_path(spark, delta, path, ["k"])
    assert _merged(spark, path) == want
    assert writers.merge_path(spark, delta.limit(0), path, ["k"]) == []
    # Rows that are let go lie in many buckets.
    writers.merge_path(spark, delta.limit(0), path, ["k"], keep=F.col("dt") > 0)
    assert _merged(spark, path) == [r for r in want if r[2] > 0]
    assert not [n for n in os.listdir(path) if n.startswith("_")]


def test_merge_deals_a_plain_folder_into_buckets(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(20).selectExpr("id as k", "1 as v").write.parquet(path)
    writers.merge_path(spark, spark.createDataFrame([(3, 2)], "k long, v int"), path, ["k"], buckets=4)
    assert _merged(spark, path) == sorted([(k, 1) for k in range(20) if k != 3] + [(3, 2)], key=repr)
    assert all(n.startswith("b") for n in os.listdir(path) if not n.startswith(("_", ".")))
    # A table without rows keeps its columns.
    none = str(tmp_path / "none")
    writers.merge_path(spark, spark.createDataFrame([], "k long, v int"), none, ["k"])
    assert spark.read.parquet(none).columns == ["k", "v"] and _merged(spark, none) == []
    writers.merge_path(spark, spark.createDataFrame([(1, 1)], "k long, v int"), none, ["k"])
    assert _merged(spark, none) == [(1, 1)]


@pytest.mark.parametrize("step", ["nothing", "deleted", "half moved"])
def test_merge_that_was_cut_off_is_ended_by_the_next(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "cut")
    rows = spark.range(50).selectExpr("id as k", "'old' as v")
    writers.merge_path(spark, rows, path, ["k"], buckets=4)
    delta = spark.range(50).selectExpr("id as k", "'new' as v")

    def cut_off(spark, path, journal):
        with open(f"{path}/{journal}", encoding="utf8") as f:
            plan = json.load(f)
        if step != "nothing":
            for name in plan["remove"]:
                os.remove(f"{path}/{name}")
        if step == "half moved":
            source, name = plan["add"][0]
            os.rename(f"{path}/{source}", f"{path}/{name}")
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(writers, "_swap", cut_off)
        with pytest.raises(KeyboardInterrupt):
            writers.merge_path(spark, delta, path, ["k"])
    last = spark.createDataFrame([(1, "last")], "k long, v string")
    writers.merge_path(spark, last, path, ["k"])
    assert _merged(spark, path) == sorted([(k, "new") for k in range(50) if k != 1] + [(1, "last")], key=repr)


def test_files_follow_the_bytes(spark, tmp_path):
    def files(rows):
        path = str(tmp_path / f"sized{rows}")
        before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        writers.write_sized(spark.range(rows), path, part_bytes=32 << 10)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
        return len([n for n in os.listdir(path) if n.endswith(".parquet")])

    few, many = files(30_000), files(120_000)
    assert few >= 2 and 2.5 * few <= many <= 6 * few


def test_partitions_are_dropped_and_found_again(spark, tmp_path):
    path = str(tmp_path / "external")
    spark.range(9).selectExpr("id", "cast(20170401 + id % 3 as int) as dt").write.partitionBy("dt").parquet(path)
    spark.sql(f"create table days_of (id bigint, dt int) using parquet partitioned by (dt) location '{path}'")
    days = lambda: sorted(r.dt for r in spark.table("days_of").select("dt").distinct().collect())
    assert days() == []
    writers.add_partitions(spark, "days_of")
    assert days() == [20170401, 20170402, 20170403]
    writers.drop_table_partition(spark, "days_of", "20170401")
    writers.drop_table_partition(spark, "days_of", "20170402", files=True)
    assert days() == [20170403]
    writers.add_partitions(spark, "days_of")
    assert days() == [20170401, 20170403]


def test_landed_lines_are_counted_while_they_land(spark, tmp_path):
    source, base, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    counter = LandedLines()
    spark.streams.addListener(counter)
    try:
        for i in range(2):
            write(source, f"{i}.log", "\n".join(f"line {i} {j}" for j in range(20 + i)))
            stream = tables.stream_topic(spark, "any", path=source)
            query = land_stream(stream, base, offsets, roll="1 second")
            query.processAllAvailable()
            query.stop()
        deadline = time.time() + 30
        while counter.of(query) < 41 and time.time() < deadline:
            time.sleep(0.2)
        assert counter.of(query) == 41
    finally:
        spark.streams.removeListener(counter)
    assert spark.read.text(base).count() == 41


def test_late_versions_do_not_win(spark, tmp_path):
    source, landed, offsets, ods = (str(tmp_path / n) for n in ("in", "landed", "offsets", "ods"))
    change = lambda key, time, op: line_of("service_order_ext", service_order_id=key, update_time=time, operation=op)
    days = {
        "20170401": [change("1", "30", "UPDATE"), change("2", "10", "UPDATE"), change("3", "10", "UPDATE")],
        # An older version of 1 comes a day late; 3 is deleted there, which ends it in that day only.
        "20170402": [change("1", "20", "UPDATE"), change("2", "20", "UPDATE"), change("3", "20", "DELETE")],
    }
    for i, (day, content) in enumerate(days.items()):
        write(source, f"{day}.log", "\n".join(content))
        stream = tables.stream_topic(spark, "any", path=source)
        noon = F.lit(1490976000 + i * 86400 + 43200)
        land_stream(stream, landed, offsets, available_now=True, arrived=noon).awaitTermination()
        logs.convert_log(spark, "service_order_ext", landed, ods, day)
    got = logs.current_state(spark, "service_order_ext", ods, list(days))
    assert tuples(got.select("service_order_id", "update_time", "dt")) == [
        (1, 30, 20170401), (2, 20, 20170402), (3, 10, 20170401)
    ]


def test_late_orders_are_accounted_for(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("orders", "slots", "state"))
    schema = "order_create_time int, expect_start_latitude double, expect_start_longitude double, pre_availableDriverNum double"
    here = (39.9, 116.4)
    batches = [
        [(1000, *here, 5.0), (1001, *here, None), (1400, *here, 5.0), (5000, *here, 2.0)],
        # Two are late; one has no time and one no place.
        [(1000, *here, 5.0), (1010, *here, 5.0), (5001, *here, 2.0), (None, *here, 1.0), (9, None, 1.0, 1.0), (9000, *here, 1.0)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        orders = spark.readStream.schema(schema).parquet(source)
        cells.start_supply_demand(orders, out, state, available_now=True).awaitTermination()
    found = cells.accounts(spark.read.parquet(source), out, state)
    assert (found.orders, found.written, found.open, found.late) == (8, 5, 1, 2)
    on_time = [r for r in batches[0] + batches[1][2:] if r[0] is not None and r[0] < 9000]
    want = supply_demand(spark.createDataFrame(on_time, schema)).where("geo_time_key is not null")
    assert tuples(spark.read.parquet(out)) == tuples(want)


def test_landing_restarts_from_its_checkpoint(spark, tmp_path):
    source, base, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    for i in range(3):
        write(source, f"{i}.log", "\n".join(f"line {i} {j}" for j in range(50)))
        stream = tables.stream_topic(spark, "any", path=source)
        land_stream(stream, base, offsets, by_hour=True, available_now=True).awaitTermination()
    got = [r.value for r in spark.read.text(base).collect()]
    assert sorted(got) == sorted(f"line {i} {j}" for i in range(3) for j in range(50))
    day = os.listdir(base)
    assert any(d.startswith("dt=20") for d in day)


def test_arrival_day_is_local(spark):
    row = with_arrival(lines(spark, "x"), by_hour=True).withColumn("now", F.current_timestamp()).first()
    assert 20200101 < row.dt < 21000101 and 0 <= row.hour < 24


def test_shared_folder_comes_from_the_session(spark):
    from cabflow.session import scratch_path, shared_folder

    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder.rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_jobs_remove_what_they_staged(spark):
    from cabflow.session import scratch, scratch_path

    before = scratch_path(spark, "kept")
    spark.range(1).write.parquet(before)
    with scratch(spark):
        outer = writers.staged(spark, spark.range(3), "outer")
        with pytest.raises(KeyError), scratch(spark):
            inner = scratch_path(spark, "inner")
            spark.range(1).write.parquet(inner)
            raise KeyError
        assert not os.path.exists(inner)
        assert outer.count() == 3
        folder = os.path.dirname(outer.inputFiles()[0].removeprefix("file://"))
        assert os.path.exists(folder)
    assert not os.path.exists(folder) and os.path.exists(before)


def test_a_machines_own_folder_is_refused_on_a_cluster():
    from types import SimpleNamespace

    from cabflow.session import shared_folder

    def session(master, warehouse, folder=None):
        conf = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": folder}
        get = SimpleNamespace(get=lambda key, default=None: conf[key] or default)
        return SimpleNamespace(conf=get, sparkContext=SimpleNamespace(getConf=lambda: get, master=master))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn", "file:/tmp/spark-warehouse"))
    assert shared_folder(session("local[8]", "file:/w/")) == "file:/w/_scratch"
    assert shared_folder(session("yarn", "hdfs://a/w")) == "hdfs://a/w/_scratch"
    assert shared_folder(session("yarn", "/w", "hdfs://a/c/")) == "hdfs://a/c"


def test_rows_are_dealt_into_partitions_without_shuffle_or_sort(spark, tmp_path):
    path, rows = str(tmp_path / "dealt"), spark.range(0, 1000, 1, 3).withColumn("dt", F.col("id") % 7)
    writers.write_dealt(rows, path, ["dt"])
    read = spark.read.parquet(path)
    assert sorted((r.id, r.dt) for r in read.collect()) == [(i, i % 7) for i in range(1000)]
    assert len(read.inputFiles()) == 21
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
