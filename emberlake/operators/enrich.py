"""Stream enrichment as batch plans: route, latest climate, co-locate, label.

Every function takes a DataFrame of decoded messages (columns as produced by
``sources.tables.feed_events`` or ``sources.messages.decode_messages``) and
is used unchanged by the batch queries and inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.functions.geo import with_geo_cell
from emberlake.functions.labels import fire_cause
from emberlake.operators.joins import left_join_small
from emberlake.operators.nest import ITEM_COLUMNS, identify, nest
from emberlake.operators.pairing import CODED_BLOCK, count_as_coded, pair_satellites
from emberlake.operators.sequence import unfold
from emberlake.operators.sizing import materialize

CLIMATE_FIELDS = ["event_ts", "latitude", "longitude", *S.CLIMATE_MEASURES,
                  "precipitation", "precipitation_type", "ghi"]

FLAT_COLUMNS = ["batch", *S.CLIMATE_COLUMNS, "geo_cell",
                *S.HOTSPOT_COLUMNS, "cause", "merged"]


def route(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into climate and satellite messages; other producers drop out."""
    pid = F.col("producer_id")
    return (messages.where(pid == S.PRODUCER_CLIMATE),
            messages.where(pid.isin(S.PRODUCER_AQUA, S.PRODUCER_TERRA)))


def latest_climate_per_batch(climate_msgs: DataFrame, batch: str = "batch",
                             precision: int = 3) -> DataFrame:
    """The last-arrived climate message of each batch wins.

    ``max(struct(arrival, ...))`` is a partial aggregate, so a batch with
    many climate messages is reduced map-side (sort-based, as the struct
    buffer holds a string; it spills rather than fails).
    """
    best = (climate_msgs.groupBy(batch)
            .agg(F.max(F.struct("arrival", *CLIMATE_FIELDS)).alias("c")))
    flat = best.select(batch, "c.*")
    return with_geo_cell(flat, precision)


def climate_record(latest: DataFrame, station: int = S.STREAM_STATION) -> DataFrame:
    """The document fields of a batch's climate message."""
    return latest.select(
        "batch", F.col("event_ts").cast("date").alias("date"),
        F.lit(station).cast("int").alias("station"), *S.CLIMATE_MEASURES,
        "precipitation", "precipitation_type", "ghi", "geo_cell")


def enrich_flat(messages: DataFrame, precision: int = 3, station: int = S.STREAM_STATION,
                check_sizes: bool = True, as_coded: bool = False, block: int = CODED_BLOCK,
                kept: list[DataFrame] | None = None) -> DataFrame:
    """Flagship: one row per (climate record x co-located hotspot).

    A batch's climate record is kept with NULL hotspot fields when no
    hotspot of its batch shares its cell (left-outer semantics); batches
    without climate emit nothing.  The left-outer join is written as an
    inner join plus an anti join: the climate side has one row per batch
    and can be broadcast (or, when large, AQE may split a hot (batch, cell)
    of the hotspot side, which a left-outer join could not).  ``as_coded``
    reproduces the original loop's duplicated and lost hotspots; copies are
    unfolded after the join, so only those in the climate's cell are made
    (``block`` and ``kept`` as in ``count_as_coded``).
    """
    climate_msgs, sat_msgs = route(messages)
    climate = climate_record(latest_climate_per_batch(climate_msgs, precision=precision), station)
    if check_sizes:
        climate = materialize(climate, "climate-per-batch")
    cells = with_geo_cell(sat_msgs, precision)
    pairs = count_as_coded(cells, block=block, kept=kept).where("copies > 0") if as_coded else pair_satellites(cells)
    pairs = pairs.withColumnRenamed("merged", "_merged")
    keys = ["batch", "geo_cell"]
    # The pairing keeps every message's (batch, cell), so the occupied keys
    # come from the messages themselves; the as-coded loop can lose all rows
    # of a cell, so there they are taken from its output.
    present = None if as_coded else cells.select(*keys).distinct()
    out = left_join_small(climate, pairs, keys, check_size=check_sizes, present=present)
    if as_coded:
        out = unfold(out, F.coalesce("copies", F.lit(1)), "_copy")
    has_hotspot = F.col("arrival").isNotNull()
    out = (out.withColumn("cause", F.when(has_hotspot, fire_cause("air_temperature_celcius", "ghi")))
              .withColumn("merged", F.col("_merged")))
    return out.select(*FLAT_COLUMNS)


def stored_documents(flat: DataFrame, source: str = "stream") -> DataFrame:
    """The enriched rows as parts of stored documents, one climate
    record a batch, with ``batch``."""
    records = identify(flat.select("batch", *S.CLIMATE_COLUMNS).distinct(), ["batch"], source)
    items = flat.where(F.col("time").isNotNull()).select("batch", *ITEM_COLUMNS)
    return nest(records, items, "batch", check_sizes=False, keep_key=True)


def enrich_documents(flat: DataFrame) -> DataFrame:
    """Nest the enriched rows into one climate document per batch.

    Used per micro-batch, where the batch size (trigger limits) bounds the
    array.  ``hotspots`` is NULL when the climate record has none.
    """
    h = F.struct(*[F.col(c) for c in S.HOTSPOT_COLUMNS], F.col("cause"))
    grouped = (flat.groupBy("batch", *S.CLIMATE_COLUMNS)
               .agg(F.array_sort(F.collect_list(F.when(F.col("time").isNotNull(), h)))
                    .alias("hs")))
    return grouped.select("batch", *S.CLIMATE_COLUMNS,
                          F.when(F.size("hs") > 0, F.col("hs")).alias("hotspots"))
