"""Streaming jobs equal their batch plans; restarts add nothing."""

import pytest
from pyspark.sql import functions as F

from emberlake.operators.enrich import enrich_documents, enrich_flat
from emberlake.plans import reports as R
from emberlake.plans import warehouse as W
from emberlake.sources.messages import read_records_stream, write_records
from emberlake.streaming import replay as SR
from emberlake.streaming.enrich import start_arrival_enrichment, start_event_time_enrichment
from emberlake.streaming.rolling import start_rolling_extremes_by_time
from emberlake.streaming.state import EpochTable
from tests.conftest import SF_SMALL


def same_rows(a, b):
    cols = sorted(a.columns)
    assert sorted(cols) == sorted(b.columns)
    ra = sorted(map(tuple, a.select(*cols).collect()), key=repr)
    rb = sorted(map(tuple, b.select(*cols).collect()), key=repr)
    assert ra == rb


def test_stream_rolling_equals_batch(spark):
    feed = W.feed(spark, SF_SMALL)
    same_rows(SR.replay_rolling_extremes(feed), R.rolling_temperature_extremes(feed))


def test_batch_membership_does_not_depend_on_files_or_trigger(spark):
    feed = W.feed(spark, SF_SMALL)
    runs = [SR.replay_arrival_enrichment(feed, batch_width=256, files_per_trigger=n) for n in (1, 100)]
    same_rows(*runs)
    coded = [SR.replay_arrival_enrichment(feed, batch_width=256, as_coded=True, files_per_trigger=n) for n in (1, 100)]
    same_rows(*coded)


def test_as_coded_stream_needs_a_width(spark, tmp_dir):
    with pytest.raises(ValueError):
        start_arrival_enrichment(spark.range(1), tmp_dir, tmp_dir, as_coded=True)


def test_nested_sink_holds_the_flat_rows(spark):
    feed = W.feed(spark, SF_SMALL)
    flat = SR.replay_arrival_enrichment(feed, batch_width=256)
    docs = SR.replay_arrival_enrichment(feed, batch_width=256, nested=True)
    cols = ["batch_id", "date", "ghi", "time", "latitude", "confidence", "cause"]
    opened = docs.select("batch_id", "date", "ghi", F.explode_outer("hotspots").alias("h")).select(
        "batch_id", "date", "ghi", "h.time", "h.latitude", "h.confidence", "h.cause")
    same_rows(flat.select(*cols), opened.select(*cols))


def test_rolling_stream_over_micro_batches(spark):
    """A missing temperature is rejected before either plan sees it."""
    feed = W.feed(spark, SF_SMALL)
    one = SR.replay_rolling_extremes(feed, files_per_trigger=100)
    same_rows(SR.replay_rolling_extremes(feed, files_per_trigger=1), one)


def test_stream_event_time_equals_batch(spark):
    feed = W.feed(spark, SF_SMALL)
    same_rows(SR.replay_event_time_enrichment(feed, files_per_trigger=3)[0], enrich_flat(feed))


def test_event_time_documents_hold_the_flat_rows(spark):
    feed = W.feed(spark, SF_SMALL)
    docs = SR.replay_event_time_enrichment(feed, nested=True)[0]
    same_rows(docs, enrich_documents(enrich_flat(feed)))


def hotspot_record(offset, hour, minute=0):
    value = ('{"producer_id": "producer_hotspot_aqua", "latitude": -37.0, "longitude": 145.0, "confidence": 70, '
             '"surface_temperature_celcius": %d, "created_time": "2024-01-01T%02d:%02d:00"}') % (offset, hour, minute)
    return "Hotspot_AQUA", 0, offset, value


def test_event_time_windows_over_micro_batches(spark, tmp_dir):
    """A slow message joins its open window, a late one is rejected, and the
    state and the staging table keep what open windows need only."""
    def start(records):
        return start_event_time_enrichment(records, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", delay="30 minutes", available_now=True,
                                           rejects_path=f"{tmp_dir}/rejects")

    def hour(offset, day, h):
        r = climate_record(offset, day)
        return (*r[:3], r[3].replace("T00:00:00", f"T{h:02d}:00:00"))

    state = EpochTable(spark, f"{tmp_dir}/ckpt-windows", "start long, n long, first_epoch long")
    run_round(spark, tmp_dir, [hour(0, 1, 5), *[hotspot_record(i, 5, i) for i in range(1, 41)]], start)
    assert sorted((r.n, r.first_epoch) for r in state.before(99).where("start IS NOT NULL").collect()) == [(41, 0)]
    run_round(spark, tmp_dir, [hour(50, 1, 6)], start)                       # watermark 05:30: the 5th hour stays open
    run_round(spark, tmp_dir, [hotspot_record(60, 5, 59)], start)            # slow, in time
    run_round(spark, tmp_dir, [hotspot_record(70, 6, 40)], start)            # watermark 06:10: the 5th hour closes
    rows = spark.read.parquet(f"{tmp_dir}/sink")
    assert rows.count() == 41 and {r.batch.hour for r in rows.collect()} == {5}
    run_round(spark, tmp_dir, [hotspot_record(80, 5, 30), ("Climate", 0, 81, "garbage"), hotspot_record(82, 6, 41)], start)
    bad = sorted((r.offset, r.reject_reason) for r in spark.read.parquet(f"{tmp_dir}/rejects").collect())
    assert bad == [(80, "late_window"), (81, "undecodable")]
    assert spark.read.parquet(f"{tmp_dir}/sink").count() == 41
    assert state.before(99).where("start IS NOT NULL").count() == 1 and len(state.epochs()) == 2
    # the 6th hour was opened by the second micro-batch
    assert min(EpochTable(spark, f"{tmp_dir}/ckpt-staging", "start long").epochs()) == 1
    run_round(spark, tmp_dir, [hotspot_record(90, 9)], start)
    assert sorted({(r.epoch, r.batch.hour) for r in spark.read.parquet(f"{tmp_dir}/sink").collect()}) == [(3, 5), (5, 6)]


def test_arrival_stream_restart_and_rejects(spark, tmp_dir):
    feed = W.feed(spark, SF_SMALL)
    write_records(spark.createDataFrame([("Climate", 0, 10**9, "garbage")],
                                        "topic string, partition int, offset long, value string"),
                  f"{tmp_dir}/records")
    first = SR.replay_arrival_enrichment(feed, batch_width=400, root=tmp_dir)
    n_docs = first.count()
    # batches are 400 arrivals each, however the files were grouped
    assert sorted(r.batch_id for r in first.select("batch_id").distinct().collect()) == [0, 1, 2]
    assert spark.read.parquet(f"{tmp_dir}/rejects").where(F.col("reject_reason") == "undecodable").count() == 1
    q = start_arrival_enrichment(read_records_stream(spark, f"{tmp_dir}/records"), f"{tmp_dir}/sink",
                                 f"{tmp_dir}/checkpoint", rejects_path=f"{tmp_dir}/rejects",
                                 available_now=True, batch_width=400)
    q.awaitTermination()                      # restart with nothing new: no output added
    assert spark.read.parquet(f"{tmp_dir}/sink").count() == n_docs


def test_processing_time_trigger_bounded_run(spark, tmp_dir):
    from emberlake.streaming.enrich import run_for
    feed = W.feed(spark, SF_SMALL)
    SR.write_batches(feed, f"{tmp_dir}/records", 400)
    q = start_arrival_enrichment(read_records_stream(spark, f"{tmp_dir}/records", max_per_trigger=1),
                                 f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", processing_time="1 second")
    run_for(q, 25)                          # T5: bounded run, then a graceful stop
    assert not q.isActive
    # every message of the feed was read, in the micro-batches that the sink names
    progress = [x for x in q.recentProgress if x["numInputRows"] > 0]
    assert len({x["batchId"] for x in progress}) >= 2
    ids = {r.batch_id for r in spark.read.parquet(f"{tmp_dir}/sink").select("batch_id").distinct().collect()}
    assert ids <= {x["batchId"] for x in progress}


def test_rejects_stream(spark, tmp_dir):
    from emberlake.streaming.enrich import start_rejects
    write_records(spark.createDataFrame(
        [("Climate", 0, 1, "garbage"),
         ("Hotspot_AQUA", 0, 2, '{"producer_id": "producer_hotspot_aqua", "latitude": 1.0, '
                                '"longitude": 2.0, "confidence": 70, "surface_temperature_celcius": 50, '
                                '"created_time": "2019-01-01T00:00:00"}')],
        "topic string, partition int, offset long, value string"), f"{tmp_dir}/records")
    q = start_rejects(read_records_stream(spark, f"{tmp_dir}/records"), f"{tmp_dir}/rejects",
                      f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination()
    got = [(r.offset, r.reject_reason) for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()]
    assert got == [(1, "undecodable")]


def test_batches_cut_across_micro_batches(spark, tmp_dir):
    """Every file cuts a batch apart; one file a trigger."""
    feed = W.feed(spark, SF_SMALL)
    whole = SR.replay_arrival_enrichment(feed, batch_width=400)
    same_rows(SR.replay_arrival_enrichment(feed, batch_width=400, split_files=7, files_per_trigger=1, root=tmp_dir), whole)
    pending = EpochTable(spark, f"{tmp_dir}/checkpoint-pending", "lane long")
    assert 1 <= len(pending.epochs()) <= 2


def test_as_coded_batches_cut_across_micro_batches(spark):
    feed = W.feed(spark, SF_SMALL)
    same_rows(SR.replay_arrival_enrichment(feed, batch_width=400, as_coded=True, split_files=5, files_per_trigger=1),
              SR.replay_arrival_enrichment(feed, batch_width=400, as_coded=True))


@pytest.mark.parametrize("as_coded, rows", [(True, 3), (False, 1)])
def test_every_batch_of_many_is_enriched(spark, tmp_dir, as_coded, rows):
    """Many more batches than stay open, over several micro-batches: none is late.

    A batch is climate, AQUA, two TERRA in another cell and a TERRA in theirs."""
    n, place = 40, F.col("id") % 5
    is_climate = place == 0
    producer = (F.when(is_climate, "producer_climate").when(place == 1, "producer_hotspot_aqua")
                .otherwise("producer_hotspot_terra"))
    feed = spark.range(5 * n).select(
        F.col("id").alias("arrival"), producer.alias("producer_id"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, CAST(id AS INT))").alias("event_ts"),
        F.when(place.isin(2, 3), -30.0).otherwise(-37.0).alias("latitude"), F.lit(145.0).alias("longitude"),
        *[F.when(is_climate, F.col("id").cast("double")).alias(c) for c in (
            "air_temperature_celcius", "relative_humidity", "windspeed_knots", "max_wind_speed", "ghi")],
        *[F.when(~is_climate, 50.0 + place).alias(c) for c in ("confidence", "surface_temperature_celcius")])
    out = SR.replay_arrival_enrichment(feed, batch_width=5, as_coded=as_coded, root=tmp_dir, files_per_trigger=2)
    got = out.groupBy("batch_id").agg(F.count("*").alias("n"), F.sum("confidence").alias("c"), F.max("ghi").alias("g"))
    assert sorted(map(tuple, got.collect())) == [(b, rows, rows * 52.5, 5.0 * b) for b in range(n)]


RECORDS = "topic string, partition int, offset long, value string"


def climate_record(offset, day, partition=0, temperature=20.0):
    value = ('{"producer_id": "producer_climate", "latitude": -37.0, "longitude": 145.0, "air_temperature_celcius": %s, '
             '"relative_humidity": 50, "windspeed_knots": 5, "max_wind_speed": 9, "precipitation": 0.0, '
             '"precipitation_type": "I", "ghi": 100, "created_date": "2024-01-%02dT00:00:00"}') % (temperature, day)
    return "Climate", partition, offset, value


def run_round(spark, root, rows, start):
    write_records(spark.createDataFrame(rows, RECORDS).coalesce(1), f"{root}/records")
    start(read_records_stream(spark, f"{root}/records")).awaitTermination()


def test_late_part_of_a_batch_is_merged_or_rejected(spark, tmp_dir):
    def start(records):
        return start_arrival_enrichment(records, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", rejects_path=f"{tmp_dir}/rejects",
                                        nested=False, available_now=True, batch_width=10, keep_batches=1)

    def batches():
        return {r.batch_id: r.date.day for r in spark.read.parquet(f"{tmp_dir}/sink").collect()}

    run_round(spark, tmp_dir, [climate_record(3, 1), climate_record(11, 2)], start)
    assert batches() == {0: 1, 1: 2}
    run_round(spark, tmp_dir, [climate_record(5, 3)], start)      # batch 0 again: its latest record is now the 3rd's
    assert batches() == {0: 3, 1: 2}
    run_round(spark, tmp_dir, [climate_record(4, 9), climate_record(31, 4)], start)
    assert batches() == {0: 3, 1: 2, 3: 4}
    run_round(spark, tmp_dir, [climate_record(7, 8), climate_record(32, 5), climate_record(2, 6, partition=1)], start)
    assert batches() == {0: 3, 1: 2, 3: 5, (1 << 40) // 10: 6}
    late = [(r.offset, r.reject_reason) for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()]
    assert late == [(7, "late_batch")]


@pytest.mark.parametrize("n_partitions", [2, 3])
def test_rolling_over_several_partitions_equals_batch(spark, tmp_dir, n_partitions):
    feed = W.feed(spark, SF_SMALL)
    got = SR.replay_rolling_extremes_by_time(feed, n_partitions, root=tmp_dir)
    assert got.where(F.col("arrival") >= 1 << 40).count() > 0
    same_rows(got.drop("arrival"), R.rolling_temperature_extremes(feed).drop("arrival"))
    same_rows(got.drop("arrival"), R.rolling_extremes_by_time(feed).drop("arrival"))
    with pytest.raises(Exception):
        spark.read.parquet(f"{tmp_dir}/rejects").first()       # nothing late, so no partition


def test_late_reading_goes_to_the_rejects(spark, tmp_dir):
    def start(records):
        return start_rolling_extremes_by_time(records, f"{tmp_dir}/sink", f"{tmp_dir}/ckpt", "2 days", f"{tmp_dir}/rejects",
                                              size=2, available_now=True)

    run_round(spark, tmp_dir, [climate_record(0, 2, 0, 10.0), climate_record(0, 1, 1, 11.0), climate_record(1, 6, 0, 12.0)], start)
    run_round(spark, tmp_dir, [climate_record(1, 3, 1, 13.0), climate_record(2, 5, 1, 14.0)], start)   # the 3rd is late
    run_round(spark, tmp_dir, [climate_record(2, 20, 0, 15.0)], start)
    rows = spark.read.parquet(f"{tmp_dir}/sink").orderBy("seq").collect()
    assert [(r.seq, r.temperature, r.min_value) for r in rows] == [(2, 10.0, 10.0), (3, 14.0, 10.0), (4, 12.0, 12.0)]
    late = [(r.partition, r.offset, r.reject_reason) for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()]
    assert late == [(1, 1, "late")]
    assert len(EpochTable(spark, f"{tmp_dir}/ckpt-buffer", "seq long").epochs()) <= 2


def test_epoch_table_reads_below_its_epoch_and_keeps_two(spark, tmp_dir):
    t = EpochTable(spark, f"{tmp_dir}/state", "x long")
    assert t.before(0).count() == 0
    for e in range(4):
        t.write(spark.createDataFrame([(e,)], "x long"), e)
    assert t.epochs() == [2, 3] and t.before(3).first().x == 2 and t.before(9).first().x == 3
    t.write(spark.createDataFrame([(33,)], "x long"), 3)           # a retried micro-batch
    assert t.epochs() == [2, 3] and t.before(4).first().x == 33
