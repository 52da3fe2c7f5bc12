"""CSV ingest, JSON messages and the historic load."""

import datetime as dt
import os

from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.plans.load import load_climate_documents
from emberlake.sources import csv as C
from emberlake.sources.messages import decode_messages, encode_messages, RECORD

FIX = os.path.join(os.path.dirname(__file__), "fixtures")


def test_climate_csv_typed_with_rejects(spark):
    raw = C.read_csv(spark, f"{FIX}/climate_small.csv", S.CLIMATE_HISTORIC_CSV)
    good, bad = C.normalize_climate_historic(raw)
    rows = {r.date: r for r in good.collect()}
    assert set(rows) == {dt.date(2018, 3, 5), dt.date(2018, 11, 14), dt.date(2017, 12, 31)}
    r = rows[dt.date(2018, 3, 5)]
    assert (r.station, r.air_temperature_celcius, r.precipitation, r.precipitation_type, r.ghi) == \
        (948701, 22.0, 0.13, "G", 201.0)
    last = rows[dt.date(2017, 12, 31)]        # last line, no trailing newline
    assert (last.precipitation, last.precipitation_type, last.ghi) == (0.35, "B", 240.0)
    assert [x.date for x in bad.collect()] == ["1/1/19"]   # air temperature 'x'


def test_hotspot_csv_and_load(spark, tmp_dir):
    raw = C.read_csv(spark, f"{FIX}/hotspot_small.csv", S.HOTSPOT_HISTORIC_CSV)
    good, bad = C.normalize_hotspot_historic(raw)
    assert good.count() == 4 and bad.count() == 1
    docs = load_climate_documents(spark, f"{FIX}/climate_small.csv", f"{FIX}/hotspot_small.csv",
                                  out_path=f"{tmp_dir}/docs", rejects_path=f"{tmp_dir}/rejects")
    by_day = {r.date: r for r in docs.collect()}
    assert len(by_day) == 3                                   # one document per climate day
    assert len(by_day[dt.date(2018, 3, 5)].hotspots) == 2      # padded and unpadded day text
    assert by_day[dt.date(2018, 3, 5)].hotspots[0].time == dt.datetime(2018, 3, 5, 4, 16, 51)
    assert len(by_day[dt.date(2018, 11, 14)].hotspots) == 1
    assert by_day[dt.date(2017, 12, 31)].hotspots is None      # no fires: NULL, not empty


def test_csv_text_roundtrip(spark, tmp_dir):
    raw = C.read_csv(spark, f"{FIX}/climate_small.csv", S.CLIMATE_HISTORIC_CSV)
    good, _ = C.normalize_climate_historic(raw)
    C.write_csv(C.climate_historic_text(good), f"{tmp_dir}/climate")
    again, bad = C.normalize_climate_historic(C.read_csv(spark, f"{tmp_dir}/climate", S.CLIMATE_HISTORIC_CSV))
    assert bad.count() == 0
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, good.collect()))
    text = open([os.path.join(f"{tmp_dir}/climate", f) for f in os.listdir(f"{tmp_dir}/climate")
                 if f.endswith(".csv")][0], newline="").read()
    assert text.startswith("station,date,") and "precipitation ,GHI_w/m2\r\n" in text
    assert " 0.13G" in text


def test_messages_roundtrip_and_rejects(spark):
    feed = spark.createDataFrame(
        [(1, S.PRODUCER_CLIMATE, dt.datetime(2019, 1, 2), -37.6, 149.3, 19.0, 56.8, 7.9, 11.1, 0.0, "I", 154.0, None, None),
         (2, S.PRODUCER_AQUA, dt.datetime(2019, 1, 2, 4, 16, 51, 123456), -37.9, 145.0, None, None, None, None, None, None, None, 78.0, 68.5)],
        "arrival long, producer_id string, event_ts timestamp_ntz, latitude double, longitude double, "
        "air_temperature_celcius double, relative_humidity double, windspeed_knots double, "
        "max_wind_speed double, precipitation double, precipitation_type string, ghi double, "
        "confidence double, surface_temperature_celcius double")
    recs = encode_messages(feed)
    assert {r.topic for r in recs.collect()} == {S.TOPIC_CLIMATE, S.TOPIC_AQUA}
    junk = spark.createDataFrame(
        [("Climate", 0, 10, "not json"),
         ("Climate", 0, 11, '{"producer_id": "producer_x", "latitude": 1.0, "longitude": 1.0, "created_date": "2019-01-01T00:00:00"}'),
         ("Hotspot_AQUA", 0, 12, '{"producer_id": "producer_hotspot_aqua", "longitude": 1.0, "created_time": "2019-01-01T00:00:00"}'),
         ("Hotspot_AQUA", 0, 13, '{"producer_id": "producer_hotspot_aqua", "latitude": 1.0, "longitude": 1.0}'),
         ("Climate", 0, 14, "")], RECORD)
    good, bad = decode_messages(recs.unionByName(junk))
    back = {r.arrival: r for r in good.collect()}
    assert back[2].event_ts == dt.datetime(2019, 1, 2, 4, 16, 51, 123456)
    assert back[2].surface_temperature_celcius == 68.5 and back[1].precipitation_type == "I"
    assert sorted((r.offset, r.reject_reason) for r in bad.collect()) == [
        (10, "undecodable"), (11, "unknown_producer"), (12, "no_position"),
        (13, "no_timestamp"), (14, "undecodable")]


def test_blank_measure_is_null_and_unreadable_is_rejected(spark):
    cols = [f.name for f in S.CLIMATE_HISTORIC_CSV.fields]
    raw = spark.createDataFrame([("1", "5/3/18", "22", "", "6", "12", " 0.13G", "2"), ("1", "6/3/18", "22", "n/a", "6", "12", " 0.1G", "2"),
                                 ("", "7/3/18", "22", "1", "6", "12", " 0.1G", "2")], cols)
    good, bad = C.normalize_climate_historic(raw)
    assert [r.relative_humidity for r in good.collect()] == [None]
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing:station", "unreadable:relative_humidity"]


def test_message_without_its_measure_is_rejected(spark):
    value = '{"producer_id": "producer_climate", "latitude": 1.0, "longitude": 2.0, "created_date": "2019-01-01T00:00:00"}'
    good, bad = decode_messages(spark.createDataFrame([("Climate", 0, 1, value)], RECORD))
    assert good.count() == 0 and bad.first().reject_reason == "no_measure"


def test_two_stations_on_a_day_stay_apart(spark):
    from emberlake.operators.nest import nest_documents
    from emberlake.plans.documents import fires_per_day
    from emberlake.plans.warehouse import from_documents
    day = dt.date(2018, 1, 3)
    climate = spark.createDataFrame([(day, st, 1.0, 2.0, 3.0, 4.0, 0.1, "G", 5.0) for st in (1, 2)],
                                    "date date, station int, air_temperature_celcius double, relative_humidity double, "
                                    "windspeed_knots double, max_wind_speed double, precipitation double, "
                                    "precipitation_type string, ghi double")
    fires = spark.createDataFrame([(day, dt.datetime(2018, 1, 3, 4), 1.0, 2.0, 60.0, 50.0)] * 5,
                                  "date date, time timestamp_ntz, latitude double, longitude double, confidence double, "
                                  "surface_temperature_celcius double")
    docs = nest_documents(climate, fires, max_items=2)
    assert from_documents(docs)[0].count() == 2
    assert [r.numberOfFires for r in fires_per_day(docs).collect()] == [5, 5]
