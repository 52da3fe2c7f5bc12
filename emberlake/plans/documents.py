"""The ten queries and two reports over stored documents (``schema.DOCUMENT``).

Whole documents are returned where the question is about records (A, E's
records, I, J).  Ranges over hotspot measures first skip documents by their
zone columns, which are plain columns that reach the Parquet scan, and then read only the
leaves of the array that the answer has (``unwind(fields=..)``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.functions.parse import DAY_FORMAT_REPORT, format_day
from emberlake.operators.nest import ITEM_COLUMNS, unwind
from emberlake.plans import catalog as C
from emberlake.plans import reports as R


def holding(docs: DataFrame, measure: str, low: float | None = None, high: float | None = None,
            below: float | None = None) -> DataFrame:
    """Documents that may hold a hotspot with ``measure`` in the bounds."""
    if low is not None:
        docs = docs.where(F.col(f"{measure}_max") >= F.lit(float(low)))
    if high is not None:
        docs = docs.where(F.col(f"{measure}_min") <= F.lit(float(high)))
    if below is not None:
        docs = docs.where(F.col(f"{measure}_min") < F.lit(float(below)))
    return docs


def climate_on_date(docs: DataFrame, day="2018-12-12") -> DataFrame:
    """A: the documents of one day, every part."""
    return docs.where(F.col("date") == C.as_day(day))


def hotspots_by_surface_temp(docs: DataFrame, low: float = 65.0, high: float = 100.0) -> DataFrame:
    """B"""
    m = "surface_temperature_celcius"
    fields = ["latitude", "longitude", m, "confidence"]
    return C.hotspots_by_surface_temp(unwind(holding(docs, m, low, high), fields=fields), low, high)


def conditions_on_dates(docs: DataFrame, days=("2018-12-15", "2018-12-16")) -> DataFrame:
    """C: the surface temperatures stay an array (find projection); its field
    path reads that leaf only."""
    return docs.where(C.on_days(days)).select(
        "date", "air_temperature_celcius", "relative_humidity", "max_wind_speed",
        F.col("hotspots.surface_temperature_celcius").alias("surface_temperatures"))


def hotspots_by_confidence(docs: DataFrame, low: float = 80.0, high: float = 100.0) -> DataFrame:
    """D"""
    fields = ["time", "surface_temperature_celcius", "confidence"]
    return C.hotspots_by_confidence(unwind(holding(docs, "confidence", low, high), fields=fields), low, high)


def hottest_hotspots(docs: DataFrame, k: int = 10) -> DataFrame:
    """E: the k hottest hotspots with their record and cause.

    The k-th largest of the documents' maxima is a lower bound of the k-th
    hottest hotspot (each of those k documents holds one), so documents below it are skipped."""
    m = "surface_temperature_celcius"
    top = docs.where(F.col(f"{m}_max").isNotNull()).select(f"{m}_max").orderBy(F.desc(f"{m}_max")).limit(k)
    bound = top.agg(F.min(f"{m}_max"), F.count(F.lit(1))).first()  # one row
    facts = unwind(holding(docs, m, bound[0] if bound[1] == k and k > 0 else None))
    order = [c for c in [*S.CLIMATE_COLUMNS, *ITEM_COLUMNS] if c != m]
    return facts.orderBy(F.desc(m), *[F.asc(c) for c in order]).limit(k)


def fires_per_day(docs: DataFrame) -> DataFrame:
    """F: fires of every document (record), its parts summed; reads no array."""
    return (docs.groupBy("doc_id", "date").agg(F.sum("n_hotspots").alias("n"))
            .select(format_day("date", DAY_FORMAT_REPORT).alias("date"), F.col("n").alias("numberOfFires")))


def low_confidence_hotspots(docs: DataFrame, below: float = 70.0) -> DataFrame:
    """G: the hotspot fields, ``cause`` included."""
    return unwind(holding(docs, "confidence", below=below)).where(
        F.col("confidence") < F.lit(float(below))).select(*ITEM_COLUMNS)


def avg_surface_temp_per_day(docs: DataFrame, digits: int | None = None) -> DataFrame:
    """H"""
    return C.avg_surface_temp_per_day(unwind(docs, fields=["surface_temperature_celcius"]), digits)


def lowest_ghi_days(docs: DataFrame, k: int = 10) -> DataFrame:
    """I: the whole documents of the k records with the lowest GHI; ties by
    date, then the identity.  At most k ids are broadcast."""
    lowest = docs.select("doc_id", "ghi", "date").distinct().orderBy("ghi", "date", "doc_id").limit(k)
    return docs.join(F.broadcast(lowest.select("doc_id")), "doc_id", "left_semi")


def days_by_precipitation(docs: DataFrame, kind: str = "G", low: float = 0.20, high: float = 0.35) -> DataFrame:
    """J: the whole documents."""
    return C.days_by_precipitation(docs, kind, low, high)


def hotspots_per_hour(docs: DataFrame) -> DataFrame:
    return R.hotspots_per_hour(unwind(docs, fields=["time"]))


def fire_markers(docs: DataFrame, since=dt.datetime(2019, 1, 1)) -> DataFrame:
    return R.fire_markers(unwind(docs), since)
