"""The raw CSV feeds, typed at the boundary with a reject side-output.

Every column is read as text with a fixed schema (no inference pass), then
cast with ``try_cast``; a row whose required field does not parse goes to
the rejects instead of failing the load.  The header has a trailing space
in ``precipitation `` and a unit in ``GHI_w/m2``; lines may end in CRLF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.functions.parse import (
    DAY_FORMAT_CSV, iso_text, parse_day, parse_iso_timestamp, split_precipitation,
)

# Day formats of the two historic files.
HOTSPOT_DAY_FORMAT = "d/M/yyyy"     # accepts 2/11/2018 and 2/01/2018
HOTSPOT_DAY_WRITE = "d/MM/yyyy"


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path))


def _num(name: str) -> Column:
    return F.trim(F.col(f"`{name}`")).try_cast("double")


def _typed(raw: DataFrame, typed: dict[str, tuple[str, Column]], required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejects as their raw text with ``reject_reason``.

    ``typed`` maps an output column to its text column and typed value.  A
    blank field is NULL, which only a ``required`` column may not be; text
    that does not parse rejects the row.
    """
    # In a generator each field is parsed once, for the reason and the output.
    parsed = raw.withColumn("_typed", F.explode(F.array(F.struct(*[v.alias(n) for n, (_, v) in typed.items()]))))
    reason = F.lit(None).cast("string")
    for name, (text, _) in reversed(typed.items()):
        blank = F.coalesce(F.trim(F.col(f"`{text}`")), F.lit("")) == ""
        if name in required:
            reason = F.when(blank, F.lit(f"missing:{name}")).otherwise(reason)
        reason = F.when(~blank & F.col(f"_typed.{name}").isNull(), F.lit(f"unreadable:{name}")).otherwise(reason)
    flagged = parsed.withColumn("reject_reason", reason)
    good = flagged.where(F.col("reject_reason").isNull()).select("_typed.*")
    return good, flagged.where(F.col("reject_reason").isNotNull()).drop("_typed")


def _weather(precip_col: str = "precipitation ") -> dict[str, tuple[str, Column]]:
    amount, kind = split_precipitation(F.col(f"`{precip_col}`"))
    return {**{c: (c, _num(c)) for c in S.CLIMATE_MEASURES}, "precipitation": (precip_col, amount),
            "precipitation_type": (precip_col, kind), "ghi": ("GHI_w/m2", _num("GHI_w/m2"))}


def normalize_climate_historic(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S1 + P1/P2/P4: typed climate records and rejects."""
    typed = {"date": ("date", parse_day(F.trim(F.col("date")), DAY_FORMAT_CSV)),
             "station": ("station", F.trim(F.col("station")).try_cast("int")), **_weather()}
    return _typed(raw, typed, ["date", "station"])


def normalize_hotspot_historic(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S2 + P1/P3: typed historic hotspots (with their day) and rejects."""
    typed = {"date": ("date", parse_day(F.trim(F.col("date")), HOTSPOT_DAY_FORMAT)),
             "time": ("datetime", parse_iso_timestamp(F.trim(F.col("datetime")))),
             **{c: (c, _num(c)) for c in ["latitude", "longitude", *S.HOTSPOT_MEASURES]}}
    return _typed(raw, typed, ["date", "time", "latitude", "longitude"])


def normalize_climate_feed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: the climate stream file (position instead of station and date)."""
    typed = {"latitude": ("latitude", _num("latitude")), "longitude": ("longitude", _num("longitude")), **_weather()}
    return _typed(raw, typed, ["latitude", "longitude"])


def normalize_satellite_feed(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One satellite's hotspot stream file."""
    cols = ["latitude", "longitude", *S.HOTSPOT_MEASURES]
    return _typed(raw, {c: (c, _num(c)) for c in cols}, cols)


# -- writers in the original text layout (round trips and replays) ----------

def _text_num(c: str) -> Column:
    return F.col(c).cast("string")


def _precip_text() -> Column:
    return F.concat(F.lit(" "), F.col("precipitation").cast("string"), F.col("precipitation_type"))


def _write(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("lineSep", "\r\n")
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("quoteAll", False).csv(path))


def climate_historic_text(climate: DataFrame) -> DataFrame:
    return climate.select(
        _text_num("station").alias("station"),
        F.date_format("date", DAY_FORMAT_CSV).alias("date"),
        *[_text_num(c).alias(c) for c in S.CLIMATE_MEASURES],
        _precip_text().alias("precipitation "), _text_num("ghi").alias("GHI_w/m2"))


def hotspot_historic_text(hotspots: DataFrame) -> DataFrame:
    return hotspots.select(
        F.date_format("date", HOTSPOT_DAY_WRITE).alias("date"),
        iso_text("time").alias("datetime"),
        *[_text_num(c).alias(c) for c in ["latitude", "longitude", *S.HOTSPOT_MEASURES]])


def climate_feed_text(climate_msgs: DataFrame) -> DataFrame:
    return climate_msgs.select(
        _text_num("latitude").alias("latitude"), _text_num("longitude").alias("longitude"),
        *[_text_num(c).alias(c) for c in S.CLIMATE_MEASURES],
        _precip_text().alias("precipitation "), _text_num("ghi").alias("GHI_w/m2"))


def satellite_feed_text(hotspot_msgs: DataFrame) -> DataFrame:
    return hotspot_msgs.select(
        *[_text_num(c).alias(c) for c in ["latitude", "longitude", *S.HOTSPOT_MEASURES]])


def write_csv(text_df: DataFrame, path: str) -> None:
    _write(text_df, path)
