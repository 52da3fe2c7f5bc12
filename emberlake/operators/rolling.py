"""Rolling extremes over the newest N readings in arrival order.

A global ``Window.orderBy`` runs in a single task.  Instead each reading
gets a dense sequence number (skew-safe numbering), readings are cut into
blocks of ``block`` consecutive numbers, and the last N-1 readings of each
block are copied into the next block as a halo.  The window then runs
per block, in parallel, and halo rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlake.functions.labels import CAPTION_MAX, CAPTION_MIN, extremes_label
from emberlake.operators.sequence import DEFAULT_BLOCK_WIDTH, number_within

DEFAULT_WINDOW = 11
DEFAULT_BLOCK = 1 << 16


def rolling_extremes(readings: DataFrame, keys: list[str], value: str = "temperature",
                     label: str = "day_label", arrival: str = "arrival",
                     size: int = DEFAULT_WINDOW, block: int = DEFAULT_BLOCK,
                     order: str | None = None, block_width: int = DEFAULT_BLOCK_WIDTH) -> DataFrame:
    """For every reading from the ``size``-th on: min and max of the newest
    ``size`` readings, the label of each extreme's first position, captions.

    The order is that of ``arrival``, or of the whole number ``order`` (in
    blocks of ``block_width``) and then ``arrival``.
    """
    block = max(block, size)
    seq = number_within(readings, keys, order or arrival, "seq", block_width, [arrival] if order else None)
    pos = F.col("seq") - 1
    # Each reading goes to its own block; the last size-1 of a block also go,
    # as halo, to the next one (one pass: explode a 1- or 2-element array).
    copies = F.when(pos % block >= block - (size - 1), F.array(F.lit(0), F.lit(1))) \
              .otherwise(F.array(F.lit(0)))
    rows = (seq.withColumn("_shift", F.explode(copies))
               .withColumn("_blk", F.floor(pos / block) + F.col("_shift"))
               .withColumn("_halo", F.col("_shift") == 1).drop("_shift"))
    w = Window.partitionBy(*keys, "_blk").orderBy("seq").rowsBetween(-(size - 1), 0)
    lo = F.min(F.struct(F.col(value).alias("v"), F.col("seq").alias("s"), F.col(label).alias("l"))).over(w)
    hi = F.max(F.struct(F.col(value).alias("v"), (-F.col("seq")).alias("s"), F.col(label).alias("l"))).over(w)
    framed = rows.select(*keys, arrival, "seq", label, value, "_halo",
                         lo.alias("lo"), hi.alias("hi"), F.count(F.lit(1)).over(w).alias("_n"))
    kept = framed.where(~F.col("_halo") & (F.col("_n") == size))
    return kept.select(
        *keys, arrival, "seq", label, value,
        F.col("lo.v").alias("min_value"), F.col("lo.l").alias("min_label_at"),
        F.col("hi.v").alias("max_value"), F.col("hi.l").alias("max_label_at"),
        extremes_label(CAPTION_MIN, F.col("lo.l"), F.col("lo.v")).alias("min_caption"),
        extremes_label(CAPTION_MAX, F.col("hi.l"), F.col("hi.v")).alias("max_caption"))
