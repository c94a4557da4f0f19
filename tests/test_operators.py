"""Operators on hand-made rows, with skew, ties and missing values."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cabflow.operators import aggregates, filters, numbering
from cabflow.operators.joins import left_join, same, semi, union_all, upsert, with_group_stats
from cabflow.operators.key_bits import KeyBits
from cabflow.operators.numbering import batch_number, number_per_key, running_total, top_k_per_key
from cabflow.operators.picking import (
    any_per_key,
    compact_changes,
    distinct_on,
    earliest_per_key,
    latest_per_key,
)


def rows(df):
    return sorted(df.collect(), key=repr)


def tuples(df):
    return [tuple(r) for r in rows(df)]


def test_latest_puts_missing_times_last_and_breaks_ties_by_content(spark):
    df = spark.createDataFrame(
        [(1, 10, "a"), (1, 10, "b"), (1, None, "z"), (2, None, "c")], "k int, t int, v string"
    )
    assert tuples(latest_per_key(df, ["k"], ["t"])) == [(1, 10, "b"), (2, None, "c")]


def test_earliest_puts_missing_times_first(spark):
    df = spark.createDataFrame(
        [(1, 10, 1), (1, None, 1), (1, 5, 0), (2, 3, 0)], "k int, t int, ok int"
    )
    assert tuples(earliest_per_key(df, ["k"], ["t"], where=F.col("ok") > 0)) == [(1, None, 1)]


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_picking_does_not_depend_on_the_partitioning(spark, parts):
    rng = random.Random(3)
    data = [(0 if i % 3 else rng.randrange(9), rng.randrange(4), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, t int, v int").repartition(parts)
    best = {}
    for k, t, v in data:
        best[k] = max(best.get(k, (-1, -1)), (t, v))
    got = {r.k: (r.t, r.v) for r in latest_per_key(df, ["k"], ["t"]).collect()}
    assert got == best


def test_any_and_distinct_on(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (1, 2, "c")], "id int, t int, v string")
    assert tuples(any_per_key(df, ["id"])) == [(1, 1, "a")]
    assert tuples(distinct_on(df, ["id", "t"])) == [(1, 1, "a"), (1, 2, "c")]


def test_change_log(spark):
    df = spark.createDataFrame(
        [
            (1, 1, "INSERT"),
            (1, 2, "UPDATE"),
            (2, 1, "INSERT"),
            (2, 2, "DELETE"),
            (3, 2, None),
            (3, 1, "INSERT"),
            (None, 9, "INSERT"),
        ],
        "id int, t int, op string",
    )
    assert tuples(compact_changes(df, "id", "t", "op")) == [(1, 2, "UPDATE")]


@pytest.fixture
def many_parts(spark):
    """Small ranges are not put together."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "23"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _hot_rows():
    rng = random.Random(5)
    # A third of the rows has one key, and one key is missing.
    return [
        (7 if i % 3 == 0 else rng.choice([1, 2, None]), rng.randrange(6), rng.randrange(9), i)
        for i in range(4000)
    ]


def test_batch_number_is_row_number_over_many_parts(spark, many_parts):
    data = _hot_rows()
    df = spark.createDataFrame(data, "k int, a int, b int, v int").repartition(5)
    got = batch_number(df, ["k"], ["a", "b"], "n", tiebreak=["v"])
    want, seen = {}, {}
    for k, a, b, v in sorted(data, key=lambda r: (str(r[0]), r[1], r[2], r[3])):
        seen[k] = seen.get(k, 0) + 1
        want[v] = seen[k]
    assert {r.v: r.n for r in got.collect()} == want
    # No window holds a key as a whole, but for the sums per part.
    windows = re.findall(r"Window \[(.*)", got._jdf.queryExecution().optimizedPlan().toString())
    assert len(windows) == 2
    assert sum("_part" in w.split("row_number")[-1] for w in windows if "row_number" in w) == 1


def test_ranges_follow_the_rows(spark, monkeypatch):
    """A hot key of a larger table has more ranges, not larger ones."""
    monkeypatch.setattr(numbering, "RANGE_ROWS", 50)
    rows = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("o"))
    got = batch_number(rows, ["k"], ["o"], "n")
    assert all(r.n == r.o + 1 for r in got.collect())
    sizes = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 500


@pytest.mark.parametrize("hot_rows", [100, 10_000])
def test_only_hot_keys_are_numbered_in_parts(spark, many_parts, hot_rows):
    data = _hot_rows()
    df = spark.createDataFrame(data, "k int, a int, b int, v int").repartition(5)
    got = number_per_key(df, ["k"], ["a", "b"], "n", tiebreak=["v"], hot_rows=hot_rows)
    want, seen = {}, {}
    for k, a, b, v in sorted(data, key=lambda r: (str(r[0]), r[1], r[2], r[3])):
        seen[k] = seen.get(k, 0) + 1
        want[v] = seen[k]
    assert {r.v: r.n for r in got.collect()} == want
    # Without a hot key nothing but the rows themselves is shuffled, once.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("Join" in plan) == (hot_rows == 100)


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_total_goes_on_over_parts(spark, many_parts, keys):
    data = [(k, a, -v if v % 2 else None, v) for k, a, _, v in _hot_rows()]
    df = spark.createDataFrame(data, "k int, a int, w int, v int").repartition(3)
    got = running_total(df, keys, [F.desc("a")], "n", value="w", tiebreak=["v"])
    want, seen = {}, {}
    for k, a, w, v in sorted(data, key=lambda r: (-r[1], r[3])):
        key = k if keys else 0
        seen[key] = seen.get(key, 0) + (w or 0)
        want[v] = seen[key]
    assert {r.v: r.n for r in got.collect()} == want
    assert running_total(df.limit(0), keys, ["a"], "n").count() == 0


def test_top_k_is_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 9)], "k int, t int")
    top = top_k_per_key(df, ["k"], [F.desc("t")], 2)
    assert tuples(top) == [(1, 2), (1, 3), (2, 9)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("often_missing", [False, True])
def test_left_join_keeps_rows_without_a_key(spark, often_missing):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (3, "d")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (1, 11), (None, 12)], "k int, w int")
    got = left_join(left, right, "k", often_missing=often_missing)
    assert got.columns == ["k", "v", "w"]
    assert set(tuples(got)) == {
        (1, "a", 10), (1, "a", 11), (None, "b", None), (None, "c", None), (3, "d", None)
    }


def test_missing_keys_are_spread_over_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).selectExpr("case when id < 0 then id end as k", "id as v")
        right = spark.range(10).selectExpr("id as k", "id as w")
        joined = left_join(left, right, "k", often_missing=True)
        used = joined.select(F.spark_partition_id().alias("p")).distinct().count()
        assert joined.count() == 4000 and used == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_semi_upsert_union(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([("c", 2), ("d", 3)], "v string, k int")
    assert tuples(semi(old, new.unionAll(new), ["k"])) == [(2, "b")]
    once = upsert(old, new, ["k"])
    assert tuples(once) == [(1, "a"), (2, "c"), (3, "d")]
    assert tuples(upsert(once, new, ["k"])) == tuples(once)
    assert tuples(union_all(old, new)) == [(1, "a"), (2, "b"), (2, "c"), (3, "d")]


def test_group_stats_leave_rows_without_a_group(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "g string, v int")
    got = with_group_stats(df, "g", [F.count(F.lit(1)).alias("n")])
    assert set(tuples(got)) == {("x", 1, 2), ("x", 2, 2), (None, 3, None)}


def test_contradictions_are_three_valued(spark):
    df = spark.createDataFrame(
        [(0.1, None), (0.1, 1), (0.0, None), (None, None), (None, 1)],
        "final_max_bidding_rate double, end_bidding_round int",
    )
    assert set(tuples(filters.no_contradiction(df))) == {(0.1, 1), (0.0, None), (None, 1)}


def test_local_day(spark):
    first, last = 1490976000, 1490976000 + 86399
    df = spark.createDataFrame([(first - 1,), (first,), (last,), (last + 1,)], "t int")
    assert tuples(filters.in_local_days(df, "t", ["20170401"])) == [(first,), (last,)]


PROFILE = (
    "user_id bigint, service_order_id bigint, final_decision_time bigint,"
    " final_decision_driver_id bigint, final_driver_bidding_rate double,"
    " final_max_bidding_rate double, min_dispatch_time int"
)


def test_user_profile(spark):
    orders = [
        (1, 1, 100, 5, 0.5, 0.5, 90),
        (1, 2, 200, 0, None, 0.2, 180),
        (1, 3, 300, 5, 0.0, None, 270),
        (2, 4, 100, 0, None, None, None),
        (None, 5, 50, 5, 0.25, 0.25, 40),
    ]
    df = spark.createDataFrame(orders, PROFILE)
    got = {r.uid: r for r in aggregates.user_profile(df).collect()}
    one = got[1]
    assert (one.user_order_count, one.user_order_decision_ok_count) == (3, 2)
    assert one.user_mean_wait_time == 20 and one.user_mean_wait_time_topk == 25
    assert (one.user_bidding_count, one.user_bidding_ok_count) == (2, 1)
    assert one.user_bidding_accept_flag == 1 and one.user_bidding_accept_pct == 0.5
    assert one.user_accept_50pct_bidding_rate == 0.5
    two = got[2]
    assert two.user_bidding_accept_flag == -1 and two.user_bidding_accept_pct == -1
    assert two.user_accept_avg_bidding_rate == -1 and two.user_mean_wait_time is None
    # A user without an id has totals, but matches no recent wait.
    assert got[None].user_order_count == 1 and got[None].user_mean_wait_time_topk is None
    literal = {r.uid: r for r in aggregates.user_profile(df, by="order").collect()}
    assert literal[1].user_mean_wait_time_topk == 20


def test_kpi(spark):
    info = spark.createDataFrame(
        [(1, 9, 5), (1, 9, 0), (2, 9, 0), (3, 0, 5), (4, None, 5), (None, 9, 5)],
        "service_order_id bigint, bidding_id bigint, decision_driver_id bigint",
    )
    assert set(tuples(aggregates.kpi_rows(info))) == {
        ("dispatch_succ_rate", "0.5000", "0"),
        ("dispatch_count_succ", "1.0000", "0"),
        ("dispatch_count_all", "2.0000", "0"),
    }


def test_observed_count_needs_no_second_pass(spark):
    df, observation = aggregates.observed(spark.range(17), "seen")
    df.write.format("noop").mode("overwrite").save()
    assert observation.get["rows"] == 17


def test_cells_without_surcharges(spark):
    df = spark.createDataFrame(
        [(39.9, 116.4, 0, None, 0.0)],
        "expect_start_latitude double, expect_start_longitude double,"
        " final_decision_driver_id int, final_driver_bidding_rate double,"
        " final_max_bidding_rate double",
    )
    row = aggregates.geo_stats(df).first()
    assert (row.geo_order_count, row.geo_bidding_pct, row.geo_bidding_ok_pct) == (1, 0.0, -1.0)


def test_key_bits_hold_every_key_and_few_others(spark, tmp_path):
    spark.range(0, 9000, 3).selectExpr("id", "cast(id % 7 as int) as t").write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    every = spark.range(9000).selectExpr("cast(id as int) as k", "cast(id % 7 as bigint) as t")
    held = {r.k for r in KeyBits(keys, ["id"]).may_hold(every, ["k"]).collect()}
    assert held >= set(range(0, 9000, 3)) and len(held) < 4000
    # More than one column, and missing values as values.
    some = spark.createDataFrame([(1, 5), (2, None)], "k int, t int")
    pairs = spark.createDataFrame([(1, 5), (1, 6), (2, 5), (2, None), (None, 5)], "k int, t int")
    assert tuples(KeyBits(some, ["k", "t"]).may_hold(pairs, ["k", "t"])) == [(1, 5), (2, None)]
    # With more keys than there is room for all of them are held, and others too.
    cramped = KeyBits(keys, ["id"], most=1 << 15)
    assert cramped.rows == 1 and {r.k for r in cramped.may_hold(every, ["k"]).collect()} >= set(range(0, 9000, 3))
    assert KeyBits(keys.limit(0), ["id"]).may_hold(every, ["k"]).count() == 0


def test_same_is_no_key_of_the_join(spark):
    left = spark.createDataFrame([(1, 5, None), (1, 6, "x"), (2, 5, "x")], "k int, a int, b string")
    right = left.selectExpr("k as _k", "struct(a, b) as _ab", "a * 10 as v").where("v < 60")
    joined = left.join(right, (F.col("k") == F.col("_k")) & same(F.struct("a", "b"), F.col("_ab")), "left")
    assert tuples(joined.select("k", "a", "v")) == [(1, 5, 50), (1, 6, None), (2, 5, 50)]
    plain = left.join(right.selectExpr("_k", "_ab.a as _a", "v"), (F.col("k") == F.col("_k")) & same(F.col("a"), F.col("_a")))
    keys = re.findall(r"Join \[([^\]]*)\]", plain.hint("merge")._jdf.queryExecution().executedPlan().toString())
    assert keys and all("," not in k for k in keys)
