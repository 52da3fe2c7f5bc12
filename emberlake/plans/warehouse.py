"""The climate model built from a warehouse folder of Parquet tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from emberlake import schema as S
from emberlake.operators.nest import hotspot_facts, nest_documents, unwind
from emberlake.plans.load import load_documents_roundtrip
from emberlake.session import scratch_path
from emberlake.sources.collection import DocumentCollection
from emberlake.sources.tables import climate_days, feed_events, hotspot_events
from emberlake.streaming.replay import replay_arrival_enrichment

# Files of the streamed part of the collection, four to a micro-batch; they cut batches apart.
COLLECTION_FILES = 8


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return climate_days(spark, sf_dir)


def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hotspot_events(spark, sf_dir)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat hotspot fact: every hotspot with its day's climate fields."""
    return hotspot_facts(climate(spark, sf_dir), hotspots(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str, max_items: int | None = None) -> DataFrame:
    kw = {"max_items": max_items} if max_items else {}
    return nest_documents(climate(spark, sf_dir), hotspots(spark, sf_dir), **kw)


def feed(spark: SparkSession, sf_dir: str, batch_unit: str = "hour") -> DataFrame:
    return feed_events(spark, sf_dir, batch_unit)


def from_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(climate records, hotspot facts) of stored documents.

    A record's fields repeat in each of its parts; equal records differ by
    ``doc_id``.  The facts are the unwound documents, ``cause`` included."""
    return docs.select("doc_id", *S.CLIMATE_COLUMNS).distinct().drop("doc_id"), unwind(docs)


_COLLECTIONS: dict[tuple[str, str], DocumentCollection] = {}


def collection(spark: SparkSession, sf_dir: str) -> DocumentCollection:
    """The historic load and the arrival stream of a folder, through CSV and
    JSON records into one collection; built once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _COLLECTIONS:
        made = DocumentCollection(spark, scratch_path(spark, "collections", uuid.uuid4().hex))
        load_documents_roundtrip(climate(spark, sf_dir), hotspots(spark, sf_dir), made)
        replay_arrival_enrichment(feed(spark, sf_dir), split_files=COLLECTION_FILES, collection=made)
        # The stream has ended: its batches become one folder, so a read does not list one for each.
        if any(k.startswith("arrival/") for k in made.manifest()):
            made.compact("arrival")
        _COLLECTIONS[key] = made
    return _COLLECTIONS[key]
