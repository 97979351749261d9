"""Scalar functions against the cases of FIXTURES part A."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dispatchkit.functions import staffing as stf
from dispatchkit.functions import timestamps as tsf
from dispatchkit.operators.joins import zone_of_point_expr

TS = dt.datetime


@pytest.mark.parametrize("text,expected", [
    ("2026-08-15 10:11:12", TS(2026, 8, 15, 10, 11, 12)),
    ("15-08-2026 10:11", TS(2026, 8, 15, 10, 11)),
    ("5-8-2026 3:4", TS(2026, 8, 5, 3, 4)),
    ("2026-8-5 3:4:5", TS(2026, 8, 5, 3, 4, 5)),
    ("2026-08-15  10:11:12", TS(2026, 8, 15, 10, 11, 12)),
    ("2026-03-08 02:30:00", TS(2026, 3, 8, 2, 30)),          # a DST gap in many zones: wall clock kept
    ("2026-02-30 01:02:03", None), ("2026-08-15", None), ("bad", None), ("26-08-15 10:11:12", None),
    ("12026-08-15 10:11:12", None), ("2026-08-15 10:11:12 ", None), ("", None), (None, None),
])
def test_parse_ts(spark, text, expected):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(text,)], "t string")
        got = df.select(tsf.parse_ts_optional("t").alias("p")).first()["p"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == expected


def test_unparseable_flags_only_present_bad_text(spark):
    df = spark.createDataFrame([("",), (None,), ("bad",), ("2026-08-15 10:11:12",)], "t string")
    assert [r[0] for r in df.select(tsf.unparseable("t")).collect()] == [False, False, True, False]


@pytest.mark.parametrize("avail,sched,pick,pack", [(49, 100, 1.35, 1.30), (50, 100, 1.15, 1.15),
                                                   (74, 100, 1.15, 1.15), (75, 100, 1.0, 1.0), (1, 0, None, None)])
def test_bands(spark, avail, sched, pick, pack):
    r = spark.createDataFrame([(avail, sched)], "a int, s int").select(
        stf.pick_staffing_band("a", "s").alias("p"), stf.pack_staffing_band("a", "s").alias("k")).first()
    assert (r["p"], r["k"]) == (pick, pack)


@pytest.mark.parametrize("hour,mult", [(6, 0.8), (7, 1.05), (10, 1.05), (11, 1.2), (13, 1.2), (14, 0.8),
                                       (17, 1.2), (21, 1.2), (22, 0.8)])
def test_demand_multiplier(spark, hour, mult):
    df = spark.createDataFrame([(TS(2026, 8, 15, hour, 30),)], "t timestamp_ntz")
    assert df.select(stf.demand_multiplier("t")).first()[0] == mult


def test_round_half_even_and_clamp(spark):
    df = spark.createDataFrame([(2.5, 3.5, None)], "a double, b double, c int")
    r = df.select(stf.round_half_even("a"), stf.round_half_even("b"), stf.clamp("c", 0, 5)).first()
    assert (r[0], r[1], r[2]) == (2.0, 4.0, None)


def test_scheduled_and_available_staff(spark):
    df = spark.createDataFrame([(120, TS(2026, 8, 15, 12, 0)), (120, TS(2026, 8, 15, 3, 0))], "cap int, t timestamp_ntz")
    p, k = stf.scheduled_staff("cap", "t")
    rows = df.select(p.alias("p"), k.alias("k"), stf.available_staff(p, 0.75).alias("a")).collect()
    # cap 120: base pickers max(2, round(3.43)) = 3, packers max(1, round(2.0)) = 2
    assert [(r.p, r.k, r.a) for r in rows] == [(4, 2, 3), (2, 2, 2)]


def test_pick_and_pack_seconds(spark):
    df = spark.createDataFrame([(3, 1, 4, 1, 2), (0, 4, 4, 2, 2)], "n int, pa int, ps int, ka int, ks int")
    r = df.select(stf.pick_seconds("n", "pa", "ps", 20, 0).alias("p"), stf.pack_seconds("ka", "ks", 60).alias("k")).collect()
    assert (r[0].p, r[0].k) == (int((90 + 60) * 1.35), int(60 * 1.15))
    assert r[1].p is None and r[1].k == 60


def test_not_before_is_null_aware(spark):
    df = spark.createDataFrame([(TS(2026, 1, 1, 0, 0, 10), TS(2026, 1, 1, 0, 0, 0)), (None, TS(2026, 1, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(tsf.not_before("a", "b", 30)).collect()]
    assert got == [TS(2026, 1, 1, 0, 0, 30), None]


def test_transit_bounds(spark):
    df = spark.createDataFrame([("SEVERE", "RAIN"), ("LOW", "CLEAR")], "t string, w string")
    lo, hi = stf.transit_bounds("t", "w")
    assert [(r[0], r[1]) for r in df.select(lo, hi).collect()] == [(9.0, 23.0), (3.0, 9.0)]


def test_zone_of_point_shared_corner(spark):
    # BLR-WST and BLR-STH boxes overlap at lat 12.925-12.935, lon 77.555-77.565
    df = spark.createDataFrame([(12.93, 77.556), (12.93, 77.564), (0.0, 0.0)], "la double, lo double")
    z, n = zone_of_point_expr("la", "lo")
    got = [(r[0], r[1]) for r in df.select(z, n).collect()]
    assert got == [("BLR-WST", 2), ("BLR-STH", 2), (None, 0)]
