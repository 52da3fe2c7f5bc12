"""Loads: CSV files -> typed records -> climate documents; feed normalisers.

``load_climate_documents`` is the historic load: both CSV files are read
with fixed schemas, typed, nested into climate documents and written with a
full overwrite (S9).  A blank measure is NULL; rows that cannot be read are
written to ``rejects_path`` with a reason.  The ``*_roundtrip``
helpers first write warehouse-derived data in the original text layout
(below the shared checkpoint folder) so the loaders run on whole tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.operators.nest import DEFAULT_MAX_ITEMS, nest_documents
from emberlake.session import scratch_path
from emberlake.sources import csv as C
from emberlake.sources.collection import DocumentCollection
from emberlake.sources.messages import decode_messages, encode_messages


def load_climate_documents(spark: SparkSession, climate_csv: str, hotspot_csv: str,
                           out_path: str | None = None, rejects_path: str | None = None,
                           max_items: int = DEFAULT_MAX_ITEMS,
                           collection: DocumentCollection | None = None) -> DataFrame:
    """S1 S2 P1-P4 J1 A3 (+ S9 when ``out_path`` or a ``collection`` is given;
    a load that fails leaves the collection's documents as they were).  Without a
    ``rejects_path`` an unreadable row fails the load instead of vanishing."""
    climate, bad_climate = C.normalize_climate_historic(C.read_csv(spark, climate_csv, S.CLIMATE_HISTORIC_CSV))
    hotspots, bad_hotspots = C.normalize_hotspot_historic(C.read_csv(spark, hotspot_csv, S.HOTSPOT_HISTORIC_CSV))
    rejects = _rejected(bad_climate, "climate").unionByName(_rejected(bad_hotspots, "hotspot"))
    if rejects_path:
        rejects.write.mode("overwrite").parquet(rejects_path)
    else:
        first = rejects.first()
        if first is not None:
            raise ValueError(f"unreadable rows need a rejects path; first: {first.file} {first.reject_reason} {first.row}")
    docs = nest_documents(climate, hotspots, max_items=max_items)
    if collection:
        return collection.read(collection.reload(docs))
    if out_path:
        # A local sort (no shuffle) gives every row group a narrow date range,
        # so date predicates on the stored documents skip row groups.
        docs.sortWithinPartitions("date", "doc_id", "part").write.mode("overwrite").parquet(out_path)
        return spark.read.parquet(out_path)
    return docs


def _rejected(bad: DataFrame, file: str) -> DataFrame:
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in bad.columns if c != "reject_reason"]))
    return bad.select(F.lit(file).alias("file"), row.alias("row"), "reject_reason")


def load_rejects_roundtrip(climate: DataFrame, hotspots: DataFrame) -> DataFrame:
    """The rejects of a load whose files were damaged by rule: on the 13th of
    a month the humidity is unreadable, on the 14th blank (which is no
    reject), on the 15th the date is unreadable; a hotspot of the 16th lacks
    its time.  One row per file and reason, with the climate rows loaded."""
    spark = climate.sparkSession
    root = _root(spark, "damaged")
    day = F.dayofmonth("date")
    text = C.climate_historic_text(climate)
    at = F.to_date("date", C.DAY_FORMAT_CSV)
    damaged = text.withColumn("relative_humidity", F.when(F.dayofmonth(at) == 13, "n/a").when(
        F.dayofmonth(at) == 14, "").otherwise(F.col("relative_humidity"))).withColumn(
        "date", F.when(F.dayofmonth(at) == 15, "someday").otherwise(F.col("date")))
    C.write_csv(damaged, f"{root}/climate")
    fires = C.hotspot_historic_text(hotspots.withColumn("time", F.when(day != 16, F.col("time"))))
    C.write_csv(fires, f"{root}/hotspot")
    docs = load_climate_documents(spark, f"{root}/climate", f"{root}/hotspot", f"{root}/documents", f"{root}/rejects")
    kept = docs.select(*S.CLIMATE_COLUMNS).distinct().agg(F.count("*").alias("n")).select(
        F.lit("climate").alias("file"), F.lit("loaded").alias("reject_reason"), "n")
    return spark.read.parquet(f"{root}/rejects").groupBy("file", "reject_reason").agg(F.count("*").alias("n")).unionByName(kept)


def _root(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "csv", f"{name}-{uuid.uuid4().hex}")


def load_documents_roundtrip(climate: DataFrame, hotspots: DataFrame,
                             collection: DocumentCollection | None = None) -> DataFrame:
    spark = climate.sparkSession
    root = _root(spark, "historic")
    C.write_csv(C.climate_historic_text(climate), f"{root}/climate_historic")
    C.write_csv(C.hotspot_historic_text(hotspots), f"{root}/hotspot_historic")
    return load_climate_documents(spark, f"{root}/climate_historic", f"{root}/hotspot_historic",
                                  out_path=f"{root}/documents", rejects_path=f"{root}/rejects", collection=collection)


def normalize_climate_feed_roundtrip(feed: DataFrame) -> DataFrame:
    """S3 P1 P4, then P6 encode and P5 decode: the climate producer's path."""
    spark = feed.sparkSession
    root = _root(spark, "climate-feed")
    climate_msgs = feed.where(F.col("producer_id") == S.PRODUCER_CLIMATE)
    C.write_csv(C.climate_feed_text(climate_msgs), f"{root}/climate_streaming")
    typed, _ = C.normalize_climate_feed(C.read_csv(spark, f"{root}/climate_streaming",
                                                   S.CLIMATE_FEED_CSV))
    msgs = typed.select("*", F.lit(S.PRODUCER_CLIMATE).alias("producer_id"),
                        F.lit("2019-01-01T00:00:00").cast("timestamp_ntz").alias("event_ts"),
                        F.lit(0).cast("long").alias("arrival"))
    decoded, _ = decode_messages(encode_messages(msgs))
    return decoded.select("latitude", "longitude", *S.CLIMATE_MEASURES, "precipitation",
                          "precipitation_type", "ghi")


def normalize_satellite_feed_roundtrip(feed: DataFrame) -> DataFrame:
    """S4 P1, then P6/P5, for both satellites (``producer_id`` kept)."""
    spark = feed.sparkSession
    root = _root(spark, "satellite-feed")
    out = None
    for producer in (S.PRODUCER_AQUA, S.PRODUCER_TERRA):
        path = f"{root}/{producer}"
        C.write_csv(C.satellite_feed_text(feed.where(F.col("producer_id") == producer)), path)
        typed, _ = C.normalize_satellite_feed(C.read_csv(spark, path, S.SATELLITE_FEED_CSV))
        msgs = typed.select("*", F.lit(producer).alias("producer_id"),
                            F.lit("2019-01-01T00:00:00").cast("timestamp_ntz").alias("event_ts"),
                            F.lit(0).cast("long").alias("arrival"))
        decoded, _ = decode_messages(encode_messages(msgs))
        part = decoded.select("producer_id", "latitude", "longitude", *S.HOTSPOT_MEASURES)
        out = part if out is None else out.unionByName(part)
    return out
