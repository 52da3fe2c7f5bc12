"""Report feeds: hotspots per hour of day, map markers, rolling extremes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.functions.labels import marker_colour, marker_popup
from emberlake.functions.parse import DAY_FORMAT_LABEL, format_day, wall_micros
from emberlake.operators.rolling import DEFAULT_WINDOW, rolling_extremes


def hotspots_per_hour(facts: DataFrame) -> DataFrame:
    """Hotspot count of every hour of the day, 0..23, zeros included.

    The per-hour count is a partial aggregate with at most 24 rows, so it
    is broadcast into the 24-row hour table by a proven bound.
    """
    spark = facts.sparkSession
    counts = facts.groupBy(F.hour("time").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    return (hours.join(F.broadcast(counts), "hour", "left")
            .select("hour", F.coalesce("n", F.lit(0)).cast("long").alias("n_hotspots")))


def fire_markers(enriched: DataFrame, since=dt.datetime(2019, 1, 1)) -> DataFrame:
    """One marker per streamed hotspot since ``since``."""
    bound = F.lit(since.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    h = enriched.where(F.col("time") >= bound)
    return h.select(
        "latitude", "longitude",
        marker_colour("cause").alias("colour"),
        marker_popup("cause", "surface_temperature_celcius", "air_temperature_celcius",
                     "relative_humidity").alias("popup"),
        "confidence")


def climate_readings(messages: DataFrame) -> DataFrame:
    """Climate messages as (stream, arrival, day label, temperature) readings."""
    return (messages.where(F.col("producer_id") == S.PRODUCER_CLIMATE)
            .select(F.col("producer_id").alias("stream"), "arrival",
                    format_day("event_ts", DAY_FORMAT_LABEL).alias("day_label"),
                    F.col("air_temperature_celcius").alias("temperature")))


# Micros of event time in a numbering block: about 12 days.
TIME_BLOCK = 1 << 40


def timed_readings(messages: DataFrame) -> DataFrame:
    """Climate readings with the micros of their event time."""
    micros = messages.select("*", wall_micros("event_ts").alias("micros")).where(F.col("producer_id") == S.PRODUCER_CLIMATE)
    return micros.select(F.col("producer_id").alias("stream"), "micros", "arrival",
                         format_day("event_ts", DAY_FORMAT_LABEL).alias("day_label"),
                         F.col("air_temperature_celcius").alias("temperature"))


def rolling_extremes_by_time(messages: DataFrame, size: int = DEFAULT_WINDOW) -> DataFrame:
    """W1 over the climate messages in the order of (event time, partition,
    offset), for feeds whose partitions run at different paces."""
    return rolling_extremes(timed_readings(messages), ["stream"], size=size, order="micros", block_width=TIME_BLOCK)


def rolling_temperature_extremes(messages: DataFrame, size: int = DEFAULT_WINDOW,
                                 block: int | None = None) -> DataFrame:
    """W1 over the climate messages in arrival order."""
    kw = {"block": block} if block else {}
    return rolling_extremes(climate_readings(messages), ["stream"], value="temperature",
                            label="day_label", size=size, **kw)
