"""Operators against plain-Python reference loops on random and edge inputs."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.operators.enrich import enrich_documents, enrich_flat
from emberlake.operators.nest import hotspot_facts, nest_documents, unwind
from emberlake.operators.pairing import pair_satellites
from emberlake.operators.rolling import rolling_extremes
from emberlake.operators.sequence import number_within

MSG_SCHEMA = ("batch long, arrival long, producer_id string, event_ts timestamp_ntz, "
              "latitude double, longitude double, air_temperature_celcius double, "
              "relative_humidity double, windspeed_knots double, max_wind_speed double, "
              "precipitation double, precipitation_type string, ghi double, "
              "confidence double, surface_temperature_celcius double")
T0 = dt.datetime(2019, 1, 1)


def hotspot_msg(batch, arrival, producer, cell, conf, surf):
    # cells are encoded as distinct latitudes far apart (one geohash cell each)
    return (batch, arrival, producer, T0 + dt.timedelta(seconds=arrival), -30.0 - 5 * cell, 145.0,
            None, None, None, None, None, None, None, conf, surf)


def climate_msg(batch, arrival, cell, air, ghi):
    return (batch, arrival, S.PRODUCER_CLIMATE, T0 + dt.timedelta(seconds=arrival),
            -30.0 - 5 * cell, 145.0, air, 50.0, 5.0, 9.0, 0.1, "G", ghi, None, None)


def greedy_pairs(aqua, terra):
    """The stated intent: each AQUA row takes the first free TERRA row of its cell."""
    free = list(terra)
    out = []
    for a in aqua:
        for i, t in enumerate(free):
            if t["cell"] == a["cell"]:
                out.append((a["arrival"], (a["conf"] + t["conf"]) / 2, (a["surf"] + t["surf"]) / 2, "both"))
                free.pop(i)
                break
        else:
            out.append((a["arrival"], a["conf"], a["surf"], "aqua"))
    out += [(t["arrival"], t["conf"], t["surf"], "terra") for t in free]
    return out


def test_pairing_equals_greedy_loop(spark):
    rng = random.Random(11)
    rows, expected = [], Counter()
    arrival = 0
    for b in range(400):
        n_cells = rng.randint(1, 4)
        aqua, terra = [], []
        for _ in range(rng.randint(0, 8)):
            arrival += 1
            sat = rng.choice([S.PRODUCER_AQUA, S.PRODUCER_TERRA])
            rec = {"arrival": arrival, "cell": rng.randrange(n_cells),
                   "conf": float(rng.randint(50, 100)), "surf": float(rng.randint(30, 120))}
            (aqua if sat == S.PRODUCER_AQUA else terra).append(rec)
            rows.append(hotspot_msg(b, arrival, sat, rec["cell"], rec["conf"], rec["surf"]))
        for p in greedy_pairs(aqua, terra):
            expected[(b, *p)] += 1
    df = spark.createDataFrame(rows, MSG_SCHEMA)
    from emberlake.functions.geo import with_geo_cell
    got = pair_satellites(with_geo_cell(df)).select(
        "batch", "arrival", "confidence", "surface_temperature_celcius", "satellite").collect()
    assert Counter(tuple(r) for r in got) == expected


def test_number_within_matches_row_number(spark):
    rng = random.Random(3)
    keys = ["hot"] * 400 + [f"k{i}" for i in range(60)] * 3 + [None] * 5
    order = rng.sample(range(10_000), len(keys))
    df = spark.createDataFrame(list(zip(keys, order)), "k string, t long")
    got = number_within(df, ["k"], "t", "rn", block_width=16)
    ref = df.withColumn("rn", F.when(F.col("k").isNotNull(),
                                     F.row_number().over(Window.partitionBy("k").orderBy("t"))))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, ref.collect()), key=repr)


def newest_windows(labels, temps, size=11):
    """Extremes of each slice of ``size`` readings, first position on ties."""
    out = []
    for end in range(size, len(temps) + 1):
        window = list(zip(temps, labels))[end - size:end]
        low = min(window, key=lambda r: r[0])
        high = max(window, key=lambda r: r[0])
        out.append((end, *low, *high))
    return out


def test_rolling_blocks_equal_loop(spark):
    rng = random.Random(5)
    n = 300
    temps = [float(rng.randint(10, 14)) for _ in range(n)]   # many ties
    labels = [f"d{i}" for i in range(n)]
    arrivals = sorted(rng.sample(range(100_000), n))
    df = spark.createDataFrame([("s", a, lab, t) for a, lab, t in zip(arrivals, labels, temps)],
                               "stream string, arrival long, day_label string, temperature double")
    got = rolling_extremes(df, ["stream"], block=16).orderBy("seq").select(
        "seq", "min_value", "min_label_at", "max_value", "max_label_at").collect()
    assert [tuple(r) for r in got] == newest_windows(labels, temps)


def test_nest_chunks_and_unwind(spark):
    climate = spark.createDataFrame(
        [(dt.date(2018, 1, d), 948700, 20.0, 50.0, 5.0, 9.0, 0.1, "G", 100.0) for d in (1, 2, 3)],
        "date date, station int, air_temperature_celcius double, relative_humidity double, "
        "windspeed_knots double, max_wind_speed double, precipitation double, "
        "precipitation_type string, ghi double")
    hs = [(dt.date(2018, 1, 1), T0 + dt.timedelta(minutes=i), -37.0, 145.0 + i * 0.01, 80.0, 60.0 + i)
          for i in range(23)]
    hs += [(dt.date(2018, 1, 2), T0, -37.0, 145.0, 70.0, 50.0),
           (dt.date(2018, 1, 9), T0, -37.0, 145.0, 70.0, 50.0)]   # no climate day: dropped
    hot = spark.createDataFrame(hs, "date date, time timestamp_ntz, latitude double, longitude double, "
                                    "confidence double, surface_temperature_celcius double")
    docs = nest_documents(climate, hot, max_items=5)
    per_day = {r.date.day: (r.n, r.fires) for r in docs.groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size(F.coalesce("hotspots", F.array()))).alias("fires")).collect()}
    assert per_day == {1: (5, 23), 2: (1, 1), 3: (1, 0)}
    assert docs.where("date = date'2018-01-03'").first().hotspots is None
    flat = unwind(docs).drop("cause")
    facts = hotspot_facts(climate, hot)
    assert sorted(map(tuple, flat.collect()), key=repr) == sorted(
        map(tuple, facts.select(*flat.columns).collect()), key=repr)


def test_enrichment_edge_cases(spark):
    A, T = S.PRODUCER_AQUA, S.PRODUCER_TERRA
    rows = [
        # batch 1: hotspots but no climate -> nothing
        hotspot_msg(1, 1, A, 0, 80.0, 60.0),
        # batch 2: climate only -> one row, NULL hotspot
        climate_msg(2, 2, 0, 25.0, 200.0),
        # batch 3: two climates (the later wins), AQUA only in its cell, TERRA elsewhere
        climate_msg(3, 3, 1, 10.0, 100.0),
        climate_msg(3, 4, 0, 25.0, 200.0),
        hotspot_msg(3, 5, A, 0, 90.0, 70.0),
        hotspot_msg(3, 6, T, 1, 60.0, 40.0),
        # batch 4: a merged pair and a TERRA leftover in the climate cell; unknown producer
        climate_msg(4, 7, 0, 15.0, 300.0),
        hotspot_msg(4, 8, T, 0, 70.0, 50.0),
        hotspot_msg(4, 9, A, 0, 90.0, 80.0),
        hotspot_msg(4, 10, T, 0, 61.0, 41.0),
        (4, 11, "producer_other", T0, -30.0, 145.0, None, None, None, None, None, None, None, 1.0, 1.0),
        # batch 5: position missing -> NULL cell, never co-located
        climate_msg(5, 12, 0, 25.0, 200.0),
        (5, 13, A, T0, None, None, None, None, None, None, None, None, None, 99.0, 99.0),
    ]
    df = spark.createDataFrame(rows, MSG_SCHEMA)
    flat = enrich_flat(df, check_sizes=False)
    got = sorted((r.batch, r.air_temperature_celcius, r.confidence, r.surface_temperature_celcius,
                  r.cause, r.merged) for r in flat.collect())
    assert got == sorted([
        (2, 25.0, None, None, None, None),
        (3, 25.0, 90.0, 70.0, "natural", False),
        (4, 15.0, 80.0, 65.0, "other", True),
        (4, 15.0, 61.0, 41.0, "other", False),
        (5, 25.0, None, None, None, None),
    ])
    docs = {r.batch: r for r in enrich_documents(flat).collect()}
    assert docs[2].hotspots is None and len(docs[4].hotspots) == 2
    assert all(r.station == S.STREAM_STATION for r in docs.values())


def counted_pairs(aqua, terra):
    """Q1 in closed form: the i-th AQUA row of a cell pairs with the cell's
    i-th TERRA row.  A paired row occurs once for each TERRA row up to its
    own that no earlier pair took, an unpaired one once for each TERRA row
    left at its turn (once if there never was any)."""
    seats = {c: [n for n, t in enumerate(terra) if t["cell"] == c] for c in {t["cell"] for t in terra}}
    turn = Counter()
    taken, out = [], []
    for a in aqua:
        mine = seats.get(a["cell"], [])[turn[a["cell"]]:][:1]
        turn[a["cell"]] += 1
        if mine:
            t = terra[mine[0]]
            copies = mine[0] + 1 - sum(n < mine[0] for n in taken)
            row = (a["arrival"], (a["conf"] + t["conf"]) / 2, (a["surf"] + t["surf"]) / 2, "both")
        else:
            copies = len(terra) - len(taken) if terra else 1
            row = (a["arrival"], a["conf"], a["surf"], "aqua")
        out += [row] * copies
        taken += mine
    return out + [(t["arrival"], t["conf"], t["surf"], "terra") for n, t in enumerate(terra) if n not in taken]


@pytest.mark.parametrize("block", [2, 8])
def test_as_coded_pairing_equals_closed_form(spark, block):
    from emberlake.functions.geo import with_geo_cell
    from emberlake.operators.pairing import pair_satellites_as_coded
    rng = random.Random(23)
    rows, expected = [], Counter()
    arrival = 0
    for b in range(300):
        n_cells = rng.randint(1, 3)
        aqua, terra = [], []
        for _ in range(90 if b % 60 == 0 else rng.randint(0, 9)):
            arrival += 1
            sat = rng.choice([S.PRODUCER_AQUA, S.PRODUCER_TERRA])
            rec = {"arrival": arrival, "cell": rng.randrange(n_cells),
                   "conf": float(rng.randint(50, 100)), "surf": float(rng.randint(30, 120))}
            (aqua if sat == S.PRODUCER_AQUA else terra).append(rec)
            rows.append(hotspot_msg(b, arrival, sat, rec["cell"], rec["conf"], rec["surf"]))
        for p in counted_pairs(aqua, terra):
            expected[(b, *p)] += 1
    df = with_geo_cell(spark.createDataFrame(rows, MSG_SCHEMA))
    got = pair_satellites_as_coded(df, block=block).select(
        "batch", "arrival", "confidence", "surface_temperature_celcius", "satellite").collect()
    assert Counter(tuple(r) for r in got) == expected
    assert sum(expected.values()) != len(rows)   # duplicates and losses do occur


def test_block_of_is_exact_for_large_offsets(spark):
    from emberlake.operators.sequence import block_of
    vals = [0, 1, (1 << 20) - 1, 1 << 20, (5 << 40) + 123456789, (1 << 52) + 1, -1]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    got = [r.b for r in df.select(block_of(F.col("v"), 1 << 20).alias("b")).collect()]
    assert got == [v >> 20 for v in vals]
    got = [r.b for r in df.select(block_of(F.col("v"), 1000).alias("b")).collect()]
    assert got[:5] == [v // 1000 for v in vals[:5]]


def test_zero_filled_hours_and_days(spark):
    from emberlake.plans.catalog import fires_per_day
    from emberlake.plans.reports import hotspots_per_hour
    facts = spark.createDataFrame(
        [(dt.date(2019, 1, 1), T0 + dt.timedelta(hours=h, minutes=m)) for h in (0, 3, 3, 23) for m in (0, 1)],
        "date date, time timestamp_ntz")
    hours = {r.hour: r.n_hotspots for r in hotspots_per_hour(facts).collect()}
    assert len(hours) == 24 and hours[3] == 4 and hours[0] == 2 and hours[16] == 0
    climate = spark.createDataFrame([(dt.date(2019, 1, 1),), (dt.date(2019, 1, 2),)], "date date")
    days = {r.date: r.numberOfFires for r in fires_per_day(climate, facts).collect()}
    assert days == {"01/01/2019": 8, "02/01/2019": 0}


def test_hot_group_is_spread_over_partitions(spark):
    """One key holding most rows is numbered by many tasks, not one."""
    rows = [("hot", i) for i in range(2000)] + [(f"k{i}", 5000 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, t long").repartition(8)
    # AQE would (rightly) merge such a tiny shuffle into one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = (number_within(df, ["k"], "t", "rn", block_width=64)
               .withColumn("pid", F.spark_partition_id()).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = [r for r in got if r.k == "hot"]
    assert len({r.pid for r in hot}) >= 4
    assert sorted(r.rn for r in hot) == list(range(1, 2001))


def test_nest_spreads_identical_copies(spark):
    climate = spark.createDataFrame(
        [(dt.date(2018, 1, 1), 948700, 20.0, 50.0, 5.0, 9.0, 0.1, "G", 100.0)],
        "date date, station int, air_temperature_celcius double, relative_humidity double, "
        "windspeed_knots double, max_wind_speed double, precipitation double, "
        "precipitation_type string, ghi double")
    same = (dt.date(2018, 1, 1), T0, -37.0, 145.0, 80.0, 60.0)
    hot = spark.createDataFrame([same] * 400, "date date, time timestamp_ntz, latitude double, "
                                              "longitude double, confidence double, "
                                              "surface_temperature_celcius double").repartition(4)
    docs = nest_documents(climate, hot, max_items=50).collect()
    sizes = sorted(len(d.hotspots) for d in docs)
    assert sum(sizes) == 400 and len(docs) == 8 and max(sizes) < 100
