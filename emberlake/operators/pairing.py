"""Pair the two satellites' hotspots that fall in the same cell.

Within a batch, each AQUA hotspot takes the first TERRA hotspot of its cell
not yet taken, in arrival order.  Matches never cross cells, so the greedy
loop pairs the i-th AQUA row of a cell with the i-th TERRA row of that
cell.  Positions come from the skew-safe block numbering; a (batch, cell,
position) group then holds at most one row per satellite, so one hash
aggregate of per-satellite ``max(when(...))`` columns builds the pairs: a
single pipeline over the messages, never a hot key in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake import schema as S
from emberlake.operators.sequence import number_within, unfold

PAIR_FIELDS = ["arrival", "event_ts", "latitude", "longitude", *S.HOTSPOT_MEASURES]

# The satellite tag of an output hotspot.
SAT_AQUA, SAT_TERRA, SAT_BOTH = "aqua", "terra", "both"


def pair_satellites(hotspots: DataFrame, batch: str = "batch", cell: str = "geo_cell") -> DataFrame:
    """One row per surviving hotspot: merged pairs, AQUA-only and TERRA-only.

    A merged row keeps AQUA's arrival, time and position and the means of the
    two confidences and surface temperatures.  Rows whose cell is NULL never
    match: each becomes a group of its own.  Output: batch, geo_cell,
    arrival, time, latitude, longitude, confidence,
    surface_temperature_celcius, satellite, merged.
    """
    sats = hotspots.where(F.col("producer_id").isin(S.PRODUCER_AQUA, S.PRODUCER_TERRA))
    numbered = number_within(sats, [batch, "producer_id", cell], "arrival", "rn")
    g = _slots(numbered, batch, cell, PAIR_FIELDS)
    return g.select(batch, cell, *_hotspot_columns())


def _slots(numbered: DataFrame, batch: str, cell: str, fields: list[str]) -> DataFrame:
    """One row per (batch, cell, ``rn``): the ``fields`` of its AQUA row as
    ``a_*`` and of its TERRA row as ``t_*``; a row without a number stays alone."""
    unplaced = F.col("rn").isNull()
    slot = F.coalesce(F.col("rn"), -1 - F.col("arrival"))
    side = F.when(unplaced, F.col("producer_id")).otherwise(F.lit(""))
    is_a = F.col("producer_id") == S.PRODUCER_AQUA
    is_t = F.col("producer_id") == S.PRODUCER_TERRA
    return numbered.groupBy(batch, cell, slot.alias("_slot"), side.alias("_side")).agg(
        *[F.max(F.when(is_a, F.col(f))).alias("a_" + f) for f in fields],
        *[F.max(F.when(is_t, F.col(f))).alias("t_" + f) for f in fields])


def _hotspot_columns() -> list[Column]:
    """The hotspot of a slot: merged, or the one that is there."""
    has_a, has_t = F.col("a_arrival").isNotNull(), F.col("t_arrival").isNotNull()
    merged = has_a & has_t

    def pick(f: str) -> Column:
        return F.when(has_a, F.col("a_" + f)).otherwise(F.col("t_" + f))

    def mean_or_pick(f: str) -> Column:
        return F.when(merged, (F.col("a_" + f) + F.col("t_" + f)) / F.lit(2.0)).otherwise(pick(f))

    satellite = (F.when(merged, F.lit(SAT_BOTH))
                  .when(has_a, F.lit(SAT_AQUA)).otherwise(F.lit(SAT_TERRA)))
    return [pick("arrival").alias("arrival"), pick("event_ts").alias("time"),
            pick("latitude").alias("latitude"), pick("longitude").alias("longitude"),
            mean_or_pick("confidence").alias("confidence"),
            mean_or_pick("surface_temperature_celcius").alias("surface_temperature_celcius"),
            satellite.alias("satellite"), merged.alias("merged")]


# -- the original loop's multiplicities (quirk Q1), within bounded batches ----

# Positions of one side of a batch in a block of the dominance count.
CODED_BLOCK = 64


def coded_block(batch_width: int) -> int:
    """A power of two near the square root of a batch's width: the grid of
    blocks and a block's own rows then stay in proportion to the batch."""
    return 1 << ((max(2, batch_width).bit_length() + 1) // 2)


def _dominated(queries: DataFrame, points: DataFrame, block: int) -> DataFrame:
    """``queries`` with ``before``: the points of the same batch with a smaller
    ``a_seq`` and a smaller ``t_seq`` (any, where the query's is NULL).

    The positions are cut into blocks both ways.  Points in whole blocks before a query's come
    from a grid of counts, summed along one side and then the other; the rest lie in its
    own block of either side, whose at most ``block`` points are tested one by one."""
    bx = F.floor((F.col("a_seq") - 1) / block).cast("long")
    by = F.floor((F.col("t_seq") - 1) / block).cast("long")
    points = points.select("batch", "a_seq", "t_seq", bx.alias("bx"), by.alias("by"))
    sizes = points.groupBy("batch").agg((F.max("bx") + 1).alias("nbx"), (F.max("by") + 1).alias("nby"))
    cells = points.groupBy("batch", "bx", "by").agg(F.count(F.lit(1)).alias("n"))
    grid = unfold(unfold(sizes, F.col("nbx") + 1, "bx"), F.col("nby") + 1, "by").join(cells, ["batch", "bx", "by"], "left")
    lower = (Window.unboundedPreceding, -1)
    left_of = F.sum("n").over(Window.partitionBy("batch", "by").orderBy("bx").rowsBetween(*lower))
    below = F.sum("_left").over(Window.partitionBy("batch", "bx").orderBy("by").rowsBetween(*lower))
    whole = grid.withColumn("_left", left_of).select("batch", F.col("bx").alias("gx"), F.col("by").alias("gy"), below.alias("_whole"))

    def held(side: str) -> DataFrame:
        return points.groupBy("batch", side).agg(F.collect_list(F.struct("a_seq", "t_seq")).alias("_near"))

    def near(test) -> Column:
        return F.coalesce(F.size(F.filter("_near", test)), F.lit(0))

    q = queries.select("*", bx.alias("bx"), by.alias("by")).join(sizes, "batch", "left")
    q = q.select("*", F.least("bx", "nbx").alias("gx"), F.coalesce("by", "nby").alias("gy")).join(whole, ["batch", "gx", "gy"], "left")
    q = q.join(held("bx"), ["batch", "bx"], "left").withColumn("_column", near(
        lambda p: (p["a_seq"] < F.col("a_seq")) & (F.col("t_seq").isNull() | (p["t_seq"] < F.col("t_seq"))))).drop("_near")
    q = q.join(held("by"), ["batch", "by"], "left").withColumn("_row", near(
        lambda p: (p["a_seq"] <= F.col("bx") * block) & (p["t_seq"] < F.col("t_seq")))).drop("_near")
    before = F.coalesce("_whole", F.lit(0)) + F.col("_column") + F.col("_row")
    return q.withColumn("before", before).drop("bx", "by", "nbx", "nby", "gx", "gy", "_whole", "_column", "_row")


def count_as_coded(hotspots: DataFrame, batch: str = "batch", block: int = CODED_BLOCK,
                   kept: list[DataFrame] | None = None) -> DataFrame:
    """Q1: the pairing with the original loop's multiplicities as ``copies``.

    An AQUA row is emitted once per TERRA row the loop passes over up to its
    match, or once per remaining TERRA row when it finds none (0 copies when the TERRA list is
    already empty).  With no TERRA rows the AQUA rows pass through once; unmatched TERRA rows are
    appended once.  The position of a match in the shrinking list is its TERRA number
    less the earlier matches with a smaller one, a dominance count.

    Batches should have a bounded width (``block`` near its square root, see
    ``coded_block``): a batch's grid has (width / block)^2 cells.  Rows without a batch belong to none.
    Input needs ``geo_cell``.  The slots are read several times: with ``kept`` they are persisted
    and appended to it, for the caller to release."""
    sats = hotspots.where(F.col("producer_id").isin(S.PRODUCER_AQUA, S.PRODUCER_TERRA) & F.col(batch).isNotNull()).select(
        F.col(batch).alias("batch"), "arrival", "producer_id", "event_ts", "latitude", "longitude",
        *S.HOTSPOT_MEASURES, "geo_cell")
    ordered = number_within(sats, ["batch", "producer_id"], "arrival", "seq")
    numbered = number_within(ordered, ["batch", "producer_id", "geo_cell"], "arrival", "rn")
    slots = _slots(numbered, "batch", "geo_cell", [*PAIR_FIELDS, "seq"])
    if kept is not None:
        kept.append(slots.persist())
    has_a, has_t = F.col("a_arrival").isNotNull(), F.col("t_arrival").isNotNull()
    aqua = _dominated(slots.where(has_a), slots.where(has_a & has_t), block)
    n_terra = sats.where(F.col("producer_id") == S.PRODUCER_TERRA).groupBy("batch").agg(F.count(F.lit(1)).alias("n_t"))
    copies = (F.when(F.col("n_t").isNull(), F.lit(1).cast("long"))
              .otherwise(F.coalesce("t_seq", "n_t") - F.col("before")).alias("copies"))
    counted = aqua.join(n_terra, "batch", "left").select("batch", "geo_cell", *_hotspot_columns(), copies)
    terra = slots.where(~has_a).select("batch", "geo_cell", *_hotspot_columns(), F.lit(1).cast("long").alias("copies"))
    return counted.unionByName(terra).withColumnRenamed("batch", batch)


def pair_satellites_as_coded(hotspots: DataFrame, batch: str = "batch", block: int = CODED_BLOCK) -> DataFrame:
    """Q1: the rows of the original loop, duplicates and losses included."""
    return unfold(count_as_coded(hotspots, batch, block), F.col("copies"), "_copy").drop("copies", "_copy")
