"""Exact per-group row numbers without putting a hot group in one task.

``row_number() over (partition by k order by t)`` sorts every row of a
group in one task, so a group holding a third of the data stalls the job.
Here the order value range is cut into fixed-width blocks: a block of a
group holds at most ``block_width`` rows (order values are distinct
integers).  The rows are shuffled once, on (group, block), for the local
numbering inside each block.  The per-block counts are taken before that
exchange, so each task sends one row per group and block; their running sum
over the few blocks of a group gives each block's starting offset, and only
that small table moves again.  A row with a NULL order value gets a NULL
number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BLOCK_WIDTH = 1 << 20


def _non_null(df: DataFrame, k: str) -> Column:
    """The key with NULL replaced by a typed default (paired with a null flag)."""
    dt = df.schema[k].dataType
    if isinstance(dt, T.StringType):
        default = F.lit("")
    elif isinstance(dt, T.BooleanType):
        default = F.lit(False)
    elif isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        default = F.lit("1970-01-01 00:00:00").cast(dt)
    else:
        default = F.lit(0).cast(dt)
    return F.coalesce(F.col(k), default)


def block_of(c: Column, width: int) -> Column:
    """Block id of an integral value: an exact shift for power-of-two widths."""
    if width > 0 and width & (width - 1) == 0:
        return F.shiftright(c.cast("long"), width.bit_length() - 1)
    return F.floor(c / F.lit(width)).cast("long")


def number_within(df: DataFrame, keys: list[str], order_col: str, out: str = "rn",
                  block_width: int = DEFAULT_BLOCK_WIDTH,
                  tiebreak: list[str] | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row within its ``keys`` group,
    ordered by the integral ``order_col`` (then ``tiebreak``).  Rows with a
    NULL key get a NULL number (they belong to no group)."""
    nk = [f"_k{i}" for i in range(len(keys))]
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    grp = ["_null", *nk, "_blk"]
    any_null = any_null | F.col(order_col).isNull()
    block = F.coalesce(block_of(F.col(order_col), block_width), F.lit(0).cast("long"))
    keyed = df.select("*", any_null.alias("_null"),
                      *[_non_null(df, k).alias(n) for k, n in zip(keys, nk)], block.alias("_blk"))
    blocked = keyed.repartition(*grp)
    order = [F.col(order_col)] + [F.col(c) for c in (tiebreak or [])]
    local = blocked.withColumn("_lrn", F.row_number().over(Window.partitionBy(*grp).orderBy(*order)))
    counts = keyed.groupBy(*grp).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy("_null", *nk).orderBy("_blk")
    offsets = counts.select(*grp, (F.sum("_n").over(running) - F.col("_n")).alias("_off"))
    rn = F.when(~F.col("_null"), F.col("_lrn") + F.col("_off"))
    return (local.join(offsets, grp).withColumn(out, rn)
            .drop("_lrn", "_off", *grp))


# Numbers that one row of a two-level sequence unfolds to.
_FAN_OUT = 1 << 16


def unfold(df: DataFrame, n: Column, out: str) -> DataFrame:
    """Each row once for every number 0 to ``n`` - 1; two levels, so that no
    array holds more than ``_FAN_OUT`` or ``n / _FAN_OUT`` numbers."""
    coarse = df.select("*", n.cast("long").alias("_count")).where("_count > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_count") - 1) / _FAN_OUT))).alias("_coarse"))
    low = F.col("_coarse") * F.lit(_FAN_OUT)
    fine = F.sequence(low, F.least(low + F.lit(_FAN_OUT), F.col("_count")) - 1)
    return coarse.select("*", F.explode(fine).alias(out)).drop("_count", "_coarse")
