"""Column expressions on hand-made values."""

from __future__ import annotations

import math
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from cabflow.functions import rules
from cabflow.functions.geo import ALPHABET, geo_time_key, geohash
from cabflow.functions.payloads import driver_rates, json_fields, number, payload_driver_rates, unescape
from cabflow.functions.times import (
    PRICING_TIME,
    date_range,
    day_bounds,
    floor_5min,
    hour_of_day,
    iso_weekday,
    shift_day,
    to_epoch,
    yesterday,
)


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def bisection(lat, lon, precision=5):
    """Textbook geohash: halve the range, longitude first."""
    ranges = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}
    bits = []
    for i in range(5 * precision):
        low, high = ranges[i % 2]
        middle = (low + high) / 2
        up = (lon if i % 2 == 0 else lat) >= middle
        ranges[i % 2] = [middle, high] if up else [low, middle]
        bits.append(int(up))
    codes = [bits[i : i + 5] for i in range(0, len(bits), 5)]
    return "".join(ALPHABET[int("".join(map(str, code)), 2)] for code in codes)


@pytest.mark.parametrize("precision", [1, 2, 5, 8, 12])
def test_geohash_is_bisection(spark, precision):
    rng = random.Random(7)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(2000)]
    edges = [-90.0, 90.0, 0.0, -0.0, 45.0]
    points += [(lat, lon) for lat in edges for lon in (-180.0, 180.0, 0.0, 116.015625)]
    points += [(math.nextafter(lat, -90), math.nextafter(116.015625, 0)) for lat in (45.0, 0.0)]
    got = values(
        spark, points, "lat double, lon double", geohash(F.col("lat"), F.col("lon"), precision)
    )
    assert got == [bisection(lat, lon, precision) for lat, lon in points]


def test_geohash_without_a_place(spark):
    rows = [(None, 116.0), (39.0, None), (91.0, 0.0), (0.0, -181.0)]
    got = values(spark, rows, "lat double, lon double", geohash(F.col("lat"), F.col("lon")))
    assert got == [None] * 4


def test_space_time_key(spark):
    rows = [(1491696300, 39.9, 116.4), (1491696299, 39.9, 116.4), (1, None, 116.4)]
    key = geo_time_key(F.col("t"), F.col("lat"), F.col("lon"))
    got = values(spark, rows, "t int, lat double, lon double", key)
    cell = bisection(39.9, 116.4)
    assert got == [f"{cell}_1491696300", f"{cell}_1491696000", None]


def test_five_minutes(spark):
    rows = [(600,), (599,), (0,), (None,)]
    assert values(spark, rows, "t int", floor_5min(F.col("t"))) == [600, 300, 0, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = [("2017-04-01 00:00:00",), ("2017-04-09 23:59:57",), ("nonsense",), (None,)]
        want = [
            int(datetime(2017, 3, 31, 16, tzinfo=timezone.utc).timestamp()),
            int(datetime(2017, 4, 9, 15, 59, 57, tzinfo=timezone.utc).timestamp()),
            None,
            None,
        ]
        assert values(spark, texts, "t string", to_epoch(F.col("t"))) == want
        pricing = [("2017-04-01_00:00:00",)]
        got = values(spark, pricing, "t string", to_epoch(F.col("t"), PRICING_TIME))
        assert got == want[:1]
        epochs = [(want[0],), (want[0] - 1,)]
        assert values(spark, epochs, "t bigint", hour_of_day(F.col("t"))) == [0, 23]
        # 1 April 2017 was a Saturday.
        assert values(spark, epochs, "t bigint", iso_weekday(F.col("t"))) == [6, 5]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_days():
    assert date_range("20170227", "20170302") == ["20170227", "20170228", "20170301"]
    assert date_range("20170301", "20170301") == []
    assert date_range("20170301", "20170301", inclusive=True) == ["20170301"]
    assert shift_day("20170301", -30) == "20170130"
    late = datetime(2017, 4, 1, 17, tzinfo=timezone.utc)
    assert yesterday(now=late) == "20170401"
    first, last = day_bounds("20170401")
    assert (first, last - first) == (1490976000, 86399)


def test_driver_rates(spark):
    rows = [
        ('{"1":{"totalMagnification":0.1},"2":{"totalMagnification":"0.3"}}',),
        ('{"1":{"totalMagnification":0.2}}',),
        ("{}",),
        ('{"1":{"totalMagnification":0.1},"2":{"N":1}}',),
        ('{"1":{"totalMagnification":0.1},"2":',),
        ("[]",),
        ("",),
        (None,),
    ]
    got = spark.createDataFrame(rows, "d string").select(driver_rates(F.col("d")).alias("r"))
    pairs = [(r.r.low, r.r.high) for r in got.collect()]
    assert pairs == [(0.1, 0.3), (0.2, 0.2)] + [(0.0, 0.0)] * 6


def test_json(spark):
    rows = [('{\\"a\\":1,\\"b\\":{\\"c\\":\\"x\\"}}',), ("broken",), (None,)]
    parsed = json_fields(unescape(F.col("j")), "a", "b", "z")
    got = spark.createDataFrame(rows, "j string").select(parsed.alias("p")).select("p.*").collect()
    assert tuple(got[0]) == ("1", '{"c":"x"}', None)
    assert tuple(got[1]) == (None, None, None) and tuple(got[2]) == (None, None, None)
    numbers = [("0.5",), ("x",), ("",), (None,)]
    assert values(spark, numbers, "t string", number(F.col("t"))) == [0.5, None, None, None]


def test_decision_type(spark):
    rows = [(1536,), (1024,), (512,), (0,), (None,)]
    got = values(spark, rows, "f int", rules.decision_type(F.col("f")))
    assert got == ["system_decision"] * 2 + ["manual_decision"] + ["unkown"] * 2


# driver, accepted rate, dispatched rate, last offered rate -> label, adjusted rate
OUTCOMES = [
    (5, 0.2, 0.2, 0.2, "bidding_decision_ok", 0.2),
    (0, None, 0.1, 0.3, "bidding_decision_failed", 0.3),
    (None, None, 0.0, 0.3, "bidding_decision_failed", 0.3),
    (5, 0.0, 0.0, None, "no_bidding_decision_ok", 0.0),
    (0, None, 0.0, 0.0, "no_bidding_decision_failed", 0.0),
    (None, None, None, None, "no_bidding_decision_failed", 0.0),
    (5, None, None, 0.3, "unkown", None),
    (-1, None, 0.1, 0.3, "unkown", 0.0),
    (0, None, 0.1, None, "no_bidding_decision_failed", None),
]


def test_label_and_rate(spark):
    df = spark.createDataFrame(
        [o[:4] for o in OUTCOMES], "d int, r double, m double, e double"
    ).select(
        rules.label(F.col("d"), F.col("r"), F.col("e")),
        rules.rate_adjust(F.col("d"), F.col("r"), F.col("m"), F.col("e")),
    )
    assert [tuple(r) for r in df.collect()] == [o[4:] for o in OUTCOMES]


def test_accept_flag(spark):
    rows = [(0, 0), (2, 0), (2, 1), (2, 2), (None, None), (1, 2)]
    got = values(spark, rows, "n int, ok int", rules.accept_flag(F.col("n"), F.col("ok")))
    assert got == [-1, 0, 1, 2, -2, -2]


def test_typed(spark):
    rows = [("7",), ("",), ("x",), ("7.5",), (None,)]
    assert values(spark, rows, "t string", rules.typed(F.col("t"), "int")) == [7] + [None] * 4
    assert values(spark, rows, "t string", rules.typed(F.col("t"), "string")) == [
        r[0] for r in rows
    ]


def test_driver_rates_out_of_the_payload_are_those_of_the_text(spark):
    drivers = ['{"a":{"totalMagnification":"0.3"},"b":{"totalMagnification":0.1}}', "{}", "null", "5", "[1]",
               '{"a":{}}', '{"a":7}', '{"a":{"totalMagnification":"x"}}']
    quoted = '"' + drivers[0].replace('"', '\\"') + '"'
    payloads = [f'{{"M":1,"driverData":{d}}}' for d in [*drivers, quoted]]
    payloads += ["broken", f'{{"driverData":{drivers[0]}', '{"M":1}', None]
    df = spark.createDataFrame([(p,) for p in payloads], "p string")
    text = F.json_tuple("p", "driverData").alias("d")
    both = df.select("p", text).select(
        "p", driver_rates(F.col("d")).alias("want"), payload_driver_rates(F.col("p")).alias("got")
    )
    rows = both.collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert [tuple(r.got) for r in rows if r.p and quoted in r.p] == [(0.1, 0.3)]
    # Drivers that are an object are not made text again.
    assert "json_tuple" not in df.select(payload_driver_rates(F.col("p")))._jdf.queryExecution().toString()
