"""Climate documents: nest hotspots under their record, and unwind them again.

The document model embeds a record's hotspots.  A record can have an
unbounded number of fires, so it is stored as *parts* of about ``max_items``
hotspots each: ``doc_id`` names the record, ``part`` the slice.  A record without fires
has one part with a NULL ``hotspots`` array.

The layout is a property of the rows: equal hotspots are counted, and a
block of copies goes to a part by its hash and its number, so a run after any other
partitioning gives the same parts, and a hotspot copied very often still spreads.
Each part carries the minimum and maximum of its hotspots' measures (the zone
columns), with which a scan skips parts before their arrays are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.operators.joins import left_join_small
from emberlake.operators.sequence import unfold
from emberlake.operators.sizing import broadcast_if_small, materialize

DEFAULT_MAX_ITEMS = 10_000
# A part takes equal hotspots in blocks of up to this share of its size.
BLOCKS_PER_PART = 32

ITEM_COLUMNS = [*S.HOTSPOT_COLUMNS, "cause"]


def identify(records: DataFrame, keys: list[str], source: str) -> DataFrame:
    """Records with their ``doc_id``: a digest of the record, its keys, its
    source and, of equal records, its number among them."""
    columns = [*dict.fromkeys([*keys, *S.CLIMATE_COLUMNS])]
    counted = records.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    numbered = unfold(counted, F.col("_n"), "_copy").drop("_n")
    digest = F.md5(F.to_json(F.struct(F.lit(source).alias("_source"), *columns, "_copy")))
    return numbered.select(digest.alias("doc_id"), F.lit(source).alias("source"), *columns)


def nest(records: DataFrame, items: DataFrame, key: str, max_items: int = DEFAULT_MAX_ITEMS,
         check_sizes: bool = True, keep_key: bool = False) -> DataFrame:
    """The parts of identified ``records`` with the ``items`` of equal
    ``key``.  Items without a record are dropped; records of one key each
    get all its items.  Within a micro-batch ``check_sizes`` is off: no side table is written."""
    if "cause" not in items.columns:
        items = items.withColumn("cause", F.lit(None).cast("string"))
    per_key = items.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if check_sizes:
        per_key, records = materialize(per_key, "hotspots-per-key"), materialize(records, "documents-without-hotspots")
    block = max(1, max_items // BLOCKS_PER_PART)
    counted = items.groupBy(key, *ITEM_COLUMNS).agg(F.count(F.lit(1)).alias("_copies"))
    blocks = unfold(counted, F.ceil(F.col("_copies") / block), "_block")
    copies = F.least(F.lit(block).cast("long"), F.col("_copies") - F.col("_block") * block).cast("int")
    n_parts = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("_n") / F.lit(max_items)))
    sized = blocks.join(broadcast_if_small(per_key) if check_sizes else per_key, key)
    placed = sized.select(key, F.pmod(F.xxhash64(*ITEM_COLUMNS, "_block"), n_parts).cast("int").alias("part"),
                          copies.alias("_copies"), *ITEM_COLUMNS)
    equal = F.array_repeat(F.struct(*ITEM_COLUMNS), F.col("_copies"))
    zones = [f(F.col(m)).alias(f"{m}_{name}") for m in S.HOTSPOT_MEASURES for name, f in (("min", F.min), ("max", F.max))]
    parts = placed.groupBy(key, "part").agg(
        F.array_sort(F.flatten(F.collect_list(equal))).alias("hotspots"), F.sum("_copies").alias("n_hotspots"), *zones)
    docs = left_join_small(records, parts, [key], check_size=check_sizes, present=per_key.select(key))
    return docs.select(*([key] if keep_key else []), "doc_id", "source", *S.CLIMATE_COLUMNS, F.coalesce("part", F.lit(0)).alias("part"),
                       F.coalesce("n_hotspots", F.lit(0)).cast("long").alias("n_hotspots"), *S.ZONE_COLUMNS, "hotspots")


def nest_documents(climate: DataFrame, hotspots: DataFrame, max_items: int = DEFAULT_MAX_ITEMS) -> DataFrame:
    """J1 over days: each climate record with the hotspots of its date."""
    return nest(identify(climate, ["date"], "historic"), hotspots, "date", max_items)


def unwind(docs: DataFrame, keep_empty: bool = False, fields: list[str] | None = None) -> DataFrame:
    """A1: one row per hotspot with its climate fields; ``keep_empty`` keeps
    fire-less documents as one row of NULL hotspot fields.

    Every field is a path of its own into the array below the generator, so a
    scan of stored documents reads the leaves of ``fields`` (default: all) only."""
    fields = fields or ITEM_COLUMNS
    gen = F.explode_outer if keep_empty else F.explode
    paths = docs.select(*S.CLIMATE_COLUMNS, *[F.col(f"hotspots.{c}").alias(c) for c in fields])
    if len(fields) == 1:
        return paths.select(*S.CLIMATE_COLUMNS, gen(fields[0]).alias(fields[0]))
    flat = paths.select(*S.CLIMATE_COLUMNS, gen(F.arrays_zip(*fields)).alias("h"))
    return flat.select(*S.CLIMATE_COLUMNS, *[F.col(f"h.{c}").alias(c) for c in fields])


def hotspot_facts(climate: DataFrame, hotspots: DataFrame) -> DataFrame:
    """Flat fact: each hotspot with the climate fields of its day.

    Same rows as ``unwind(nest_documents(...))`` without building arrays.
    The climate side (one row per day) is materialised and broadcast when
    its counted size allows, so the hotspot side is never shuffled.
    """
    days = broadcast_if_small(materialize(climate, "climate-days"))
    hs = hotspots.select("date", *S.HOTSPOT_COLUMNS)
    return hs.join(days, "date").select(*S.CLIMATE_COLUMNS, *S.HOTSPOT_COLUMNS)
