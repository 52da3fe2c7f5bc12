"""Scalar column functions: geohash cell, parsing, labels."""

import datetime as dt
import random

from pyspark.sql import functions as F

from emberlake.functions.geo import GEOHASH_ALPHABET, geo_cell
from emberlake.functions.labels import extremes_label, fire_cause, marker_popup
from emberlake.functions.parse import format_day, parse_day, split_precipitation


def bisect_geohash(lat, lon, precision):
    """Textbook interval-halving encoder (value on the midpoint goes up)."""
    lat_lo, lat_hi, lon_lo, lon_hi = -90.0, 90.0, -180.0, 180.0
    bits, even, out, ch, n = 0, True, [], 0, 0
    while len(out) < precision:
        if even:
            mid = (lon_lo + lon_hi) / 2
            bit = lon >= mid
            lon_lo, lon_hi = (mid, lon_hi) if bit else (lon_lo, mid)
        else:
            mid = (lat_lo + lat_hi) / 2
            bit = lat >= mid
            lat_lo, lat_hi = (mid, lat_hi) if bit else (lat_lo, mid)
        ch = ch * 2 + int(bit)
        n += 1
        even = not even
        if n == 5:
            out.append(GEOHASH_ALPHABET[ch])
            ch, n = 0, 0
    return "".join(out)


def test_geo_cell_matches_bisection(spark):
    rng = random.Random(7)
    pts = [(rng.uniform(-89.9, 89.9), rng.uniform(-179.9, 179.9)) for _ in range(3000)]
    pts += [(-39 + k * 0.1, 141 + j * 0.1) for k in range(48) for j in range(0, 84, 7)]
    pts += [(-37.96875, 142.03125), (0.0, 0.0), (-33.75, 146.25)]  # cell edges
    df = spark.createDataFrame(pts, "lat double, lon double")
    for p in (1, 3, 5, 7):
        got = df.select("lat", "lon", geo_cell("lat", "lon", p).alias("g")).collect()
        for r in got:
            assert r.g == bisect_geohash(r.lat, r.lon, p), (r, p)


def test_geo_cell_known_values_and_nulls(spark):
    df = spark.createDataFrame(
        [(57.64911, 10.40744), (-37.8409, 144.9464), (None, 1.0), (95.0, 1.0)], "lat double, lon double")
    got = [r.g for r in df.select(geo_cell("lat", "lon", 3).alias("g")).collect()]
    assert got[0] == "u4p"          # the well-known example point
    assert got[1] == "r1r"          # Melbourne
    assert got[2] is None and got[3] is None


def test_parse_day_two_digit_years_and_padding(spark):
    df = spark.createDataFrame([("31/12/17",), ("2/1/18",), ("02/01/18",), ("5/6/99",), ("x",)], "d string")
    got = [r.v for r in df.select(parse_day("d").alias("v")).collect()]
    assert got == [dt.date(2017, 12, 31), dt.date(2018, 1, 2), dt.date(2018, 1, 2),
                   dt.date(1999, 6, 5), None]


def test_split_precipitation(spark):
    df = spark.createDataFrame([(" 0.02G",), ("0.35 I",), (" 1.10A",), ("  B",), ("",)], "p string")
    a, k = split_precipitation("p")
    got = [(r.a, r.k) for r in df.select(a.alias("a"), k.alias("k")).collect()]
    assert got == [(0.02, "G"), (0.35, "I"), (1.10, "A"), (None, "B"), (None, None)]


def test_day_formats(spark):
    df = spark.createDataFrame([(dt.date(2018, 1, 2),)], "d date")
    r = df.select(format_day("d", "dd/MM/yyyy").alias("a"), format_day("d", "d/MM/yy").alias("b"),
                  format_day("d", "d/MM/yyyy").alias("c")).first()
    assert (r.a, r.b, r.c) == ("02/01/2018", "2/01/18", "2/01/2018")


def test_cause_popup_and_caption(spark):
    df = spark.createDataFrame([(21.0, 181.0, 45.9, 60.5), (20.0, 250.0, 18.9, 10.0),
                                (None, 300.0, 1.0, 1.0)], "air double, ghi double, s double, h double")
    rows = df.select(fire_cause("air", "ghi").alias("c"),
                     marker_popup(fire_cause("air", "ghi"), "s", "air", "h").alias("p"),
                     extremes_label("Minimum", F.lit("2/01/18"), F.col("air")).alias("l")).collect()
    assert [r.c for r in rows] == ["natural", "other", "other"]
    assert rows[0].p == ("<b>Cause:</b> natural</br><b>Surface Temperature:</b> 45</br>"
                         "<b>Air Temperature:</b> 21</br><b>Relative Humidity:</b> 60")
    assert rows[1].p.endswith("<b>Surface Temperature:</b> 18</br><b>Air Temperature:</b> 20"
                              "</br><b>Relative Humidity:</b> 10")
    assert rows[0].l == "Minimum (Date: 2/01/18 & Temp: 21.0)"


def test_timestamps_ignore_the_session_time_zone(spark):
    """A wall-clock time inside a DST gap survives format, parse and truncation."""
    from emberlake.functions.parse import iso_text, parse_iso_timestamp, trunc_ntz
    gap = dt.datetime(1998, 4, 5, 2, 38, 30, 250000)       # no such time in New York
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(gap,)], "t timestamp_ntz")
        r = df.select(iso_text("t").alias("s"), parse_iso_timestamp(iso_text("t")).alias("back"),
                      trunc_ntz("t", "hour").alias("h"), trunc_ntz("t", "day").alias("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.s == "1998-04-05T02:38:30.25"
    assert r.back == gap
    assert r.h == dt.datetime(1998, 4, 5, 2) and r.d == dt.datetime(1998, 4, 5)
