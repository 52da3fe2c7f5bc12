"""Climate, hotspot and message-feed inputs derived from the warehouse tables.

The test warehouse holds TPC-H-like tables; these functions give them the
shape of the climate model (one climate record per day, one hotspot per
line item, one feed message per event).  Each function reads only the
columns it needs, so the Parquet scan prunes everything else, and none of
them shuffles except ``climate_days`` (one partial aggregate per day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.functions.parse import split_precipitation, trunc_ntz


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def _dbl(c: Column) -> Column:
    return c.cast("double")


def climate_days_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw climate record per order date, taken from its smallest order.

    ``precipitation_text`` keeps the feed's text form (`` 0.02G``) so that the
    normaliser is exercised on every row.  ``min`` and ``min_by`` over
    primitive columns run as a hash aggregate with a map-side partial step:
    each map task reduces its rows to one per day before the shuffle, so a
    day holding a third of all orders costs no more than any other.
    """
    o = read_table(spark, sf_dir, "orders", "o_orderdate", "o_orderkey", "o_custkey")
    first = (o.groupBy(F.col("o_orderdate").cast("date").alias("date"))
              .agg(F.min("o_orderkey").alias("k"), F.min_by("o_custkey", "o_orderkey").alias("c")))
    k, c = F.col("k"), F.col("c")
    precip = F.concat(F.lit(" 0."), F.lpad((k % 60).cast("string"), 2, "0"),
                      F.substr(F.lit("GIAB"), (k % 4 + 1).cast("int"), F.lit(1)))
    return first.select(
        "date",
        (F.lit(948700) + c % 3).cast("int").alias("station"),
        _dbl(5 + k % 28).alias("air_temperature_celcius"),
        _dbl(30 + k % 38).alias("relative_humidity"),
        _dbl(1 + k % 19).alias("windspeed_knots"),
        _dbl(5 + k % 26).alias("max_wind_speed"),
        precip.alias("precipitation_text"),
        _dbl(47 + k % 219).alias("ghi"),
    )


def normalize_climate_records(raw: DataFrame) -> DataFrame:
    """Split the precipitation text and order the columns as a climate record."""
    amount, kind = split_precipitation("precipitation_text")
    return raw.select(
        "date", "station", *S.CLIMATE_MEASURES,
        amount.alias("precipitation"), kind.alias("precipitation_type"), "ghi")


def climate_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed climate records (``climate_doc`` without hotspots)."""
    return normalize_climate_records(climate_days_raw(spark, sf_dir))


def hotspot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One historic hotspot per line item: day, time, position, measures."""
    li = read_table(spark, sf_dir, "lineitem",
                    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    secs = (F.col("l_orderkey") * 7919) % 86400
    return li.select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.timestamp_add("SECOND", secs, F.col("l_shipdate")).cast("timestamp_ntz").alias("time"),
        (F.lit(-39.0) + _dbl((F.col("l_partkey") * 7) % 48) * F.lit(0.1)).alias("latitude"),
        (F.lit(141.0) + _dbl((F.col("l_suppkey") * 13) % 84) * F.lit(0.1)).alias("longitude"),
        _dbl(50 + F.col("l_partkey") % 51).alias("confidence"),
        _dbl(28 + (F.col("l_orderkey") + F.col("l_linenumber")) % 96).alias("surface_temperature_celcius"),
    )


def feed_events(spark: SparkSession, sf_dir: str, batch_unit: str = "hour") -> DataFrame:
    """Decoded message feed: one message per event, routed to three producers.

    Columns: ``arrival`` (the event id, the order messages arrived in),
    ``batch`` (``date_trunc(batch_unit, ts)``: the micro-batch a message
    fell into), ``producer_id``, ``event_ts`` and the measures; a climate
    message carries only climate measures, a hotspot message only hotspot
    measures.
    """
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    producer = (F.when(et == "view", F.lit(S.PRODUCER_CLIMATE))
                 .when(et.isin("click", "signup"), F.lit(S.PRODUCER_AQUA))
                 .when(et.isin("purchase", "error"), F.lit(S.PRODUCER_TERRA)))
    is_climate = et == "view"
    is_hotspot = et.isin("click", "signup", "purchase", "error")

    def climate_only(c: Column) -> Column:
        return F.when(is_climate, c)

    def hotspot_only(c: Column) -> Column:
        return F.when(is_hotspot, c)

    return e.select(
        eid.alias("arrival"),
        trunc_ntz(F.col("ts"), batch_unit).alias("batch"),
        producer.alias("producer_id"),
        F.col("ts").cast("timestamp_ntz").alias("event_ts"),
        (F.lit(-39.0) + _dbl((uid * 7) % 48) * F.lit(0.1)).alias("latitude"),
        (F.lit(141.0) + _dbl((uid * 13) % 84) * F.lit(0.1)).alias("longitude"),
        climate_only(_dbl(5 + eid % 28)).alias("air_temperature_celcius"),
        climate_only(_dbl(30 + eid % 38)).alias("relative_humidity"),
        climate_only(_dbl(1 + eid % 19)).alias("windspeed_knots"),
        climate_only(_dbl(5 + eid % 26)).alias("max_wind_speed"),
        climate_only(_dbl(eid % 60) / F.lit(100.0)).alias("precipitation"),
        climate_only(F.substr(F.lit("GIAB"), (eid % 4 + 1).cast("int"), F.lit(1))).alias("precipitation_type"),
        climate_only(_dbl(100 + eid % 150)).alias("ghi"),
        hotspot_only(_dbl(50 + eid % 51)).alias("confidence"),
        hotspot_only(_dbl(30 + eid % 90)).alias("surface_temperature_celcius"),
    )
