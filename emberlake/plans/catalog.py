"""The ten document queries (A-J) as parameterised DataFrame plans.

``climate`` is one record per day (``climate_doc`` without hotspots);
``facts`` is the flat hotspot fact (each hotspot with its day's climate
fields), i.e. the unwound documents.  Filters on top-level columns reach
the Parquet scan; top-k queries plan as ``TakeOrderedAndProject`` (each
task keeps its own k best, only k rows per task move).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.functions.parse import DAY_FORMAT_REPORT, format_day
from emberlake.operators.joins import left_join_small


def as_day(d) -> F.Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)))


def on_days(days) -> F.Column:
    """Date in a list, as equalities: unlike an in-list of cast days, Spark
    turns each into a range on the stored column and pushes it to the scan."""
    wanted = F.lit(False)
    for d in days:
        wanted = wanted | (F.col("date") == as_day(d))
    return wanted


def climate_on_date(climate: DataFrame, day="2018-12-12") -> DataFrame:
    """A: the climate record of one day (0 or 1 row; the least of several)."""
    return climate.where(F.col("date") == as_day(day)).orderBy(*S.CLIMATE_COLUMNS).limit(1)


def hotspots_by_surface_temp(facts: DataFrame, low: float = 65.0, high: float = 100.0) -> DataFrame:
    """B: position, surface temperature and confidence of hotspots in a range."""
    t = F.col("surface_temperature_celcius")
    return (facts.where(t.between(F.lit(float(low)), F.lit(float(high))))
                 .select("latitude", "longitude", "surface_temperature_celcius", "confidence"))


def conditions_on_dates(climate: DataFrame, hotspots: DataFrame,
                        days=("2018-12-15", "2018-12-16")) -> DataFrame:
    """C, flat: weather of the given days with each hotspot's surface
    temperature (one row per hotspot; NULL when the day had none).

    The picked days (at most ``len(days)`` rows) are broadcast into the
    hotspots of those days, so even a hot day's fires are never gathered.
    """
    picked = F.broadcast(climate.where(on_days(days)))
    temps = hotspots.where(on_days(days)).select("date", "surface_temperature_celcius")
    return (left_join_small(picked, temps, ["date"], check_size=False)
            .select("date", "air_temperature_celcius", "relative_humidity",
                    "max_wind_speed", "surface_temperature_celcius"))


def hotspots_by_confidence(facts: DataFrame, low: float = 80.0, high: float = 100.0) -> DataFrame:
    """D: time, air and surface temperature, confidence for a confidence range."""
    c = F.col("confidence")
    return (facts.where(c.between(F.lit(float(low)), F.lit(float(high))))
                 .select("time", "air_temperature_celcius", "surface_temperature_celcius", "confidence"))


def hottest_hotspots(facts: DataFrame, k: int = 10) -> DataFrame:
    """E: the k hottest hotspots with their day's record.  Ties are broken by
    every other output column, so the answer is deterministic."""
    cols = [*S.CLIMATE_COLUMNS, *S.HOTSPOT_COLUMNS]
    rest = [c for c in cols if c != "surface_temperature_celcius"]
    return (facts.select(*cols)
                 .orderBy(F.col("surface_temperature_celcius").desc(), *[F.col(c).asc() for c in rest])
                 .limit(k))


def fires_per_day(climate: DataFrame, hotspots: DataFrame) -> DataFrame:
    """F: number of fires of every climate day, zero included.

    Counting per day is a partial aggregate (one row per day leaves each
    map task); the day table is then joined to the climate days.
    """
    counts = hotspots.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return (climate.select("date").join(counts, "date", "left")
            .select(format_day("date", DAY_FORMAT_REPORT).alias("date"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("numberOfFires")))


def low_confidence_hotspots(facts: DataFrame, below: float = 70.0) -> DataFrame:
    """G: the hotspot fields of fires with confidence below a bound."""
    return (facts.where(F.col("confidence") < F.lit(float(below)))
                 .select(*S.HOTSPOT_COLUMNS))


def avg_surface_temp_per_day(facts: DataFrame, digits: int | None = None) -> DataFrame:
    """H: mean surface temperature of each day that had fires (``digits``
    rounds it for display; by default the mean is returned as computed)."""
    avg = F.avg("surface_temperature_celcius")
    return (facts.groupBy("date").agg(avg.alias("avg"))
            .select(format_day("date", DAY_FORMAT_REPORT).alias("date"),
                    (F.round("avg", digits) if digits is not None else F.col("avg")).alias("avgTemp")))


def lowest_ghi_days(climate: DataFrame, k: int = 10) -> DataFrame:
    """I: the k days with the lowest GHI; ties by date."""
    return climate.orderBy(F.col("ghi").asc(), F.col("date").asc()).limit(k)


def days_by_precipitation(climate: DataFrame, kind: str = "G",
                          low: float = 0.20, high: float = 0.35) -> DataFrame:
    """J: days of one precipitation type with an amount in a closed range."""
    p = F.col("precipitation")
    return climate.where((F.col("precipitation_type") == F.lit(kind))
                         & p.between(F.lit(float(low)), F.lit(float(high))))
