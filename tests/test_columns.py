"""Boundary tables of the column expressions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hazeframe import fixed_values as fv
from hazeframe.functions import aqi, geo, naming, times, traffic, units


def one(df):
    return [r[0] for r in df.collect()]


def expected_index(c, bands):
    if c is None:
        return None
    for c_lo, c_hi, i_lo, i_hi in bands:
        if c <= c_hi:
            return i_lo + (c - c_lo) * (i_hi - i_lo) / (c_hi - c_lo)
    return None


@pytest.mark.parametrize("table,fn", [(fv.US_BREAKPOINTS, aqi.us_aqi), (fv.VN_BREAKPOINTS, aqi.vn_aqi)])
def test_index_at_every_bound(spark, table, fn):
    rows = [(p, c) for p, bands in table.items()
            for c in [None, -1.0] + [x for lo, hi, _, _ in bands for x in (lo, hi, hi + 0.05)] + [bands[-1][1] + 1]]
    got = one(spark.createDataFrame(rows, "p string, c double").select(fn("p", "c")))
    for (p, c), g in zip(rows, got):
        want = expected_index(c, table[p])
        assert (g is None) == (want is None), (p, c, g, want)
        assert g is None or abs(g - want) < 1e-9


def test_index_unknown_parameter_and_case(spark):
    got = one(spark.createDataFrame([("PM25", 12.0), ("nh3", 5.0)], "p string, c double").select(aqi.us_aqi("p", "c")))
    assert got == [50.0, None]


def test_index_to_concentration(spark):
    rows = [("pm25", 0.0, 0.0), ("pm25", -3.0, 0.0), ("pm25", 50.0, 12.0), ("pm25", 50.5, 50.5), ("pm25", 600.0, 499.38 + 101.42),
            ("co", 100.0, 9.4), ("o3", 400.0, 106 + 199 * 94 / 99), ("nh3", 42.0, 42.0), ("nh3", 0.0, 0.0)]
    got = one(spark.createDataFrame([r[:2] for r in rows], "p string, i double").select(aqi.aqi_to_concentration("p", "i")))
    for (p, i, want), g in zip(rows, got):
        if (p, i) == ("pm25", 600.0):
            want = 350.5 + (600 - 401) * (500.4 - 350.5) / 99
        assert abs(g - want) < 0.006, (p, i, g, want)


def test_main_pollutant_modes(spark):
    subs = {p: p for p in fv.POLLUTANTS}
    df = spark.createDataFrame([(80.0, None, None, None, None, None), (5.0, 5.0, 1.0, 1.0, 1.0, 1.0), (1.0, 2.0, 3.0, 4.0, 9.0, 8.0), (None,) * 6],
                               ", ".join(f"{p} double" for p in fv.POLLUTANTS))
    assert one(df.select(aqi.main_pollutant(subs))) == ["o3", "pm25", "so2", "o3"]
    assert one(df.select(aqi.main_pollutant(subs, null_safe=True))) == ["pm25", "pm25", "so2", None]


def test_co_mislabelled_ppm(spark):
    df = spark.createDataFrame([("co", 9.9, "ppm"), ("co", 10.0, "ppm"), ("o3", 2.0, "ppb"), ("pm25", 2.0, "ppb"), ("o3", 2.0, "ppm")], "p string, v double, u string")
    assert one(df.select(units.to_ugm3("p", "v", "u"))) == pytest.approx([9.9 * 1145, 11.45, 3.92, 2.0, 2.0])


def test_quality_flag(spark):
    df = spark.createDataFrame([("pm25", v) for v in (-1.0, 0.0, 500.0, 501.0)] + [("co", -9.0)], "p string, v double")
    assert one(df.select(units.quality_flag("p", "v"))) == ["implausible", "valid", "valid", "implausible", "valid"]


def test_regions_cover_every_province(spark):
    df = spark.createDataFrame([(p,) for p in fv.PROVINCES + ["elsewhere"]], "p string")
    rows = df.select("p", naming.region_3("p").alias("a"), naming.region_8("p").alias("b")).collect()
    assert [r.a for r in rows].count("Unknown") == 1 and [r.b for r in rows].count("Unknown") == 1
    assert len({r.b for r in rows}) == 9 and len(fv.PROVINCES) == 34


def test_station_time(spark):
    rows = [("2026-06-08T15:00:00+07:00", None, None), (None, "2026-06-08 15:00:00", "+07:00"), (None, "2026-06-08 15:00:00", None),
            ("2026-06-08T15:00:00Z", None, None), ("bad", "2026-06-08 15:00:00", "+09:00"), (None, None, None)]
    got = spark.createDataFrame(rows, "a string, b string, c string").select(
        F.date_format(times.station_time_to_utc("a", "b", "c"), "HH").alias("h")).collect()
    assert [r.h for r in got] == ["08", "08", "08", "15", "06", None]


def test_hour_boundaries_and_health_class(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 59), datetime(2024, 1, 1, 1, 0)), (datetime(2024, 1, 1, 1, 0), datetime(2024, 1, 1, 1, 59))], "a timestamp, b timestamp")
    assert one(df.select(times.hours_between("a", "b"))) == [1, 0]
    lags = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 24, 25)], "l int")
    assert one(lags.select(naming.health_class("l"))) == ["Fresh", "Delayed", "Delayed", "Stale", "Stale", "Offline"]


def test_grid_rounds_half_even(spark):
    points = [(21.0285, 105.85), (0.1, 0.3), (0.5, 0.5), (0.7, 1.1)]  # 0.1/0.2 and 0.5/0.2 are exact ties
    df = spark.createDataFrame(points, "lat double, lon double")
    want = [f"grid_{round(a / 0.2) * 0.2:.1f}_{round(b / 0.2) * 0.2:.1f}" for a, b in points]
    assert want[1].startswith("grid_0.0") and want[2] == "grid_0.4_0.4"
    assert one(df.select(geo.grid_key("lat", "lon"))) == want


def test_congestion_and_codes(spark):
    df = spark.createDataFrame([(120, 100, 0.0, 0.0), (0, 0, 30.0, 60.0), (0, 0, 0.0, 0.0), (900, 100, 1.0, 1.0), (80, 100, 0.0, 0.0)], "a int, b int, c double, d double")
    assert one(df.select(traffic.congestion_ratio("a", "b", "c", "d"))) == pytest.approx([0.2, 1.0, 0.0, 5.0, 0.0])
    codes = spark.createDataFrame([("7",), ("123.0",), ("123456",)], "c string")
    assert one(codes.select(naming.padded_code("c"))) == ["00007", "00123", "123456"]


def test_comparison_ranges():
    r = times.comparison_ranges(date(2024, 1, 1), date(2024, 3, 15))
    assert (r["current_start"], r["previous_start"], r["previous_end"]) == (date(2024, 2, 15), date(2024, 1, 16), date(2024, 2, 14))
