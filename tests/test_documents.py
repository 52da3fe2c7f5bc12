"""Stored documents: identity, zones, pruning, and the collection's commits."""

import contextlib
import datetime as dt
import io
import os

import pytest
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.operators.enrich import enrich_flat
from emberlake.operators.nest import nest_documents, unfold, unwind
from emberlake.plans import documents as D
from emberlake.plans import warehouse as W
from emberlake.sources.collection import DocumentCollection, read_documents
from emberlake.streaming import replay as SR
from tests.conftest import SF_SMALL
from tests.test_streaming import climate_record, hotspot_record, run_round, same_rows
from emberlake.streaming.enrich import start_arrival_enrichment

CLIMATE = ("date date, station int, air_temperature_celcius double, relative_humidity double, windspeed_knots double, "
           "max_wind_speed double, precipitation double, precipitation_type string, ghi double")
FIRES = ("date date, time timestamp_ntz, latitude double, longitude double, confidence double, "
         "surface_temperature_celcius double")


def day(d):
    return dt.date(2018, 1, d)


def climate_rows(spark, *days):
    return spark.createDataFrame([(day(d), 948700, 20.0, 50.0, 5.0, 9.0, 0.1, "G", 100.0 + d) for d in days], CLIMATE)


def fire(d, surface, minute=0, confidence=80.0):
    return day(d), dt.datetime(2018, 1, d, 3, minute), -37.0, 145.0, confidence, float(surface)


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_unfold_counts_over_both_levels(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 65_536), ("d", 65_537), ("e", 200_000)], "k string, n long")
    got = unfold(df, F.col("n"), "i").groupBy("k").agg(F.count("*"), F.min("i"), F.max("i"), F.countDistinct("i"))
    assert sorted(map(tuple, got.collect())) == [
        (k, n, 0, n - 1, n) for k, n in (("b", 1), ("c", 65_536), ("d", 65_537), ("e", 200_000))]


def test_layout_is_a_property_of_the_rows(spark):
    """Copies spread over parts, and any partitioning gives the same parts."""
    fires = spark.createDataFrame([fire(1, 60)] * 900 + [fire(1, 50 + i, i) for i in range(40)] + [fire(2, 70)], FIRES)
    climate = climate_rows(spark, 1, 2, 3)
    a = nest_documents(climate, fires, max_items=100)
    b = nest_documents(climate.repartition(5), fires.repartition(7, F.rand(3)), max_items=100)
    same_rows(a, b)
    sizes = [r.n_hotspots for r in a.where("date = date'2018-01-01'").collect()]
    assert sum(sizes) == 940 and len(sizes) >= 9 and max(sizes) <= 200
    assert a.where("size(hotspots) <> n_hotspots").count() == 0
    zones = a.where("date = date'2018-01-02'").first()
    assert (zones.surface_temperature_celcius_min, zones.surface_temperature_celcius_max) == (70.0, 70.0)
    empty = a.where("date = date'2018-01-03'").collect()
    assert len(empty) == 1 and empty[0].hotspots is None and empty[0].n_hotspots == 0


def test_equal_records_are_documents_of_their_own(spark):
    docs = nest_documents(climate_rows(spark, 1, 1, 2), spark.createDataFrame([fire(1, 60)] * 5, FIRES), max_items=2)
    assert sorted((r.date, r.numberOfFires) for r in D.fires_per_day(docs).collect()) == [
        ("01/01/2018", 5), ("01/01/2018", 5), ("02/01/2018", 0)]
    assert docs.select("doc_id").distinct().count() == 3
    assert W.from_documents(docs)[0].count() == 3
    same_rows(D.lowest_ghi_days(docs, 2), docs.where(F.col("date") == F.lit(day(1))))


def test_nulls_and_empty_tables(spark):
    climate = climate_rows(spark, 1).withColumn("ghi", F.lit(None).cast("double"))
    fires = spark.createDataFrame([fire(1, 60), (day(1), None, None, None, None, None), (None, *fire(1, 60)[1:])], FIRES)
    docs = nest_documents(climate, fires)
    assert [r.n_hotspots for r in docs.collect()] == [2]
    assert nest_documents(climate, fires.limit(0)).first().hotspots is None
    assert nest_documents(climate.limit(0), fires).count() == 0


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    c = DocumentCollection(spark, path)
    c.reload(nest_documents(W.climate(spark, SF_SMALL), W.hotspots(spark, SF_SMALL), max_items=3))
    return c.read()


def test_answers_over_parts_equal_the_flat_facts(spark, stored):
    from emberlake.plans import catalog as C
    climate, facts = W.climate(spark, SF_SMALL), W.facts(spark, SF_SMALL)
    same_rows(D.hotspots_by_surface_temp(stored), C.hotspots_by_surface_temp(facts))
    same_rows(D.hotspots_by_confidence(stored), C.hotspots_by_confidence(facts))
    same_rows(D.low_confidence_hotspots(stored).drop("cause"), C.low_confidence_hotspots(facts))
    same_rows(D.hottest_hotspots(stored).drop("cause"), C.hottest_hotspots(facts))
    same_rows(D.avg_surface_temp_per_day(stored), C.avg_surface_temp_per_day(facts))
    same_rows(D.fires_per_day(stored), C.fires_per_day(climate, W.hotspots(spark, SF_SMALL)))
    assert D.hottest_hotspots(stored, 0).count() == 0
    assert D.hottest_hotspots(stored, 10**6).count() == facts.count()


def read_schema(df):
    return [line for line in plan_text(df).splitlines() if "ReadSchema" in line]


def test_scans_read_the_leaves_they_need(stored):
    leaf = "hotspots:array<struct<surface_temperature_celcius:double>>"
    assert leaf in read_schema(D.avg_surface_temp_per_day(stored))[0]
    assert leaf in read_schema(D.conditions_on_dates(stored, ("2018-01-01",)))[0]
    assert "hotspots:array<struct<time:timestamp_ntz>>" in read_schema(unwind(stored, fields=["time"]).select("time"))[0]
    for q in (D.hotspots_by_surface_temp(stored), D.hotspots_by_confidence(stored)):
        schema = read_schema(q)[0]
        assert "cause" not in schema and ("time" in schema) != ("latitude" in schema)
    assert "hotspots:array" not in read_schema(D.fires_per_day(stored))[0]


def test_zones_reach_the_scan_and_skip_documents(stored):
    q = D.hotspots_by_surface_temp(stored, 120, 130)
    assert "GreaterThanOrEqual(surface_temperature_celcius_max,120.0)" in plan_text(q)
    m = "surface_temperature_celcius"
    skipped = D.holding(stored, m, 120, 130).count()
    assert skipped < stored.count() and q.count() == unwind(stored).where(F.col(m).between(120, 130)).count()


def test_reload_swaps_and_a_failed_one_leaves_the_old(spark, tmp_dir):
    c = DocumentCollection(spark, tmp_dir)
    assert c.read().count() == 0 and c.read().columns == S.DOCUMENT.names
    none = spark.createDataFrame([], FIRES)
    first = c.reload(nest_documents(climate_rows(spark, 1, 2), none))
    c.append(nest_documents(climate_rows(spark, 5), none), "stream/0")
    c.append(nest_documents(climate_rows(spark, 6), none), "stream/0")          # a retry replaces
    assert sorted(r.date.day for r in c.read().collect()) == [1, 2, 6]
    broken = nest_documents(climate_rows(spark, 3), none).withColumn("ghi", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        c.reload(broken)
    assert sorted(r.date.day for r in read_documents(spark, tmp_dir).collect()) == [1, 2, 6]
    c.reload(nest_documents(climate_rows(spark, 9), none))
    assert [r.date.day for r in c.read().collect()] == [9]
    assert sorted(r.date.day for r in c.read(first).collect()) == [1, 2]        # an older snapshot


def test_of_two_writers_one_starts_again(spark, tmp_dir):
    c = DocumentCollection(spark, tmp_dir)
    none = spark.createDataFrame([], FIRES)
    c.reload(nest_documents(climate_rows(spark, 1), none))
    other, raced = DocumentCollection(spark, tmp_dir), []

    def change(old):
        if not raced:                      # another writer commits between our read and our rename
            raced.append(other.append(nest_documents(climate_rows(spark, 2), none), "stream/1"))
        return {**old, "stream/2": c._write(nest_documents(climate_rows(spark, 3), none))}

    assert c._commit(change) == 3
    assert sorted(r.date.day for r in c.read().collect()) == [1, 2, 3]
    assert sorted(c.manifest()) == ["historic", "stream/1", "stream/2"]


def test_compact_and_vacuum(spark, tmp_dir):
    c = DocumentCollection(spark, tmp_dir)
    none = spark.createDataFrame([], FIRES)
    c.reload(nest_documents(climate_rows(spark, 1), none))
    for d in (2, 3, 4):
        c.append(nest_documents(climate_rows(spark, d), none), f"stream/{d}")
    c.compact("stream")
    assert sorted(c.manifest()) == ["historic", "stream"]
    assert len(c.vacuum(keep=1)) == 3 and len(c.versions()) == 1
    assert sorted(r.date.day for r in c.read().collect()) == [1, 2, 3, 4]


def test_a_later_part_replaces_the_documents_of_its_batch(spark, tmp_dir):
    c = DocumentCollection(spark, f"{tmp_dir}/docs")

    def start(records):
        return start_arrival_enrichment(records, None, f"{tmp_dir}/ckpt", available_now=True, batch_width=10, collection=c)

    run_round(spark, tmp_dir, [climate_record(0, 1), hotspot_record(1, 5), climate_record(12, 2)], start)
    assert sorted((r.date.day, r.n_hotspots) for r in c.read().collect()) == [(1, 1), (2, 0)]
    run_round(spark, tmp_dir, [hotspot_record(2, 6)], start)
    assert sorted((r.date.day, r.n_hotspots) for r in c.read().collect()) == [(1, 2), (2, 0)]


def test_a_batch_is_one_file(spark, tmp_dir):
    c = DocumentCollection(spark, tmp_dir)
    docs = nest_documents(climate_rows(spark, 1, 2, 3, 4, 5, 6), spark.createDataFrame([], FIRES))
    c.append_each(docs.withColumn("batch", F.dayofmonth("date") % 2).repartition(4, "date"), "batch", "arrival")
    files = [f for _, _, names in os.walk(f"{tmp_dir}/data") for f in names if f.endswith(".parquet")]
    assert len(files) == 2 and c.read().count() == 6


def test_both_stream_jobs_fill_the_collection(spark, tmp_dir):
    feed = W.feed(spark, SF_SMALL)
    flat = SR.replay_arrival_enrichment(feed, batch_width=400)
    c = DocumentCollection(spark, f"{tmp_dir}/arrival")
    docs = SR.replay_arrival_enrichment(feed, batch_width=400, collection=c)
    cols = [*S.CLIMATE_COLUMNS, *S.HOTSPOT_COLUMNS, "cause"]
    same_rows(unwind(docs, keep_empty=True).select(*cols), flat.select(*cols))
    c = DocumentCollection(spark, f"{tmp_dir}/event-time")
    SR.replay_event_time_enrichment(feed, collection=c)
    same_rows(unwind(c.read(), keep_empty=True).select(*cols), enrich_flat(feed).select(*cols))
