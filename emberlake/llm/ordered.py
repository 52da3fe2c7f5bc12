"""Running sums over a total order of a whole table, without a hot task.

The rows are range-partitioned by the full order, so a source or conversation
that holds a third of all rows is cut like any other stretch.  A window runs
inside each range only, and one row for each range, at most as many as there
are shuffle partitions, carries the sums of the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import OWN, staged

RANGE = OWN + "range"


def running(df: DataFrame, order: list[Column], sums: dict[str, Column], name: str) -> DataFrame:
    """Add, for each entry of ``sums``, the sum of its whole-number expression
    over the rows before this one in ``order``.

    Rows that tie in all of ``order`` get sums in any order, so ties must be
    rows that are interchangeable.  ``df`` is read twice (once for a sample
    of the ranges) and should be cheap to read."""
    ranged = staged(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), name)
    before = (Window.unboundedPreceding, -1)
    totals = ranged.groupBy(RANGE).agg(*[F.sum(v).alias(OWN + k) for k, v in sums.items()])
    earlier = Window.orderBy(RANGE).rowsBetween(*before)
    offsets = totals.select(RANGE, *[F.coalesce(F.sum(OWN + k).over(earlier), F.lit(0)).alias(OWN + k) for k in sums])
    inside = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(*before)
    local = ranged.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(k) for k, v in sums.items()])
    # One row for each range: no more than there are shuffle partitions.
    placed = local.join(F.broadcast(offsets), RANGE)
    return placed.select(*df.columns, *[(F.col(k) + F.col(OWN + k)).cast("long").alias(k) for k in sums])


def counted_out(df: DataFrame, n: Column, out: str, step: int = 4096) -> DataFrame:
    """Each row ``n`` times, numbered from 0 in ``out``; a row with a large
    count is dealt over tasks in stretches of ``step`` first."""
    first = OWN + "first"
    stretches = df.withColumn(OWN + "n", n.cast("long")).filter(F.col(OWN + "n") > 0).withColumn(
        first, F.explode(F.sequence(F.lit(0).cast("long"), F.col(OWN + "n") - 1, F.lit(step).cast("long"))))
    few = stretches.filter(F.col(OWN + "n") <= step)
    many = stretches.filter(F.col(OWN + "n") > step)
    many = many.repartition(*[c for c in many.columns if c != OWN + "n"])
    last = F.least(F.col(first) + step, F.col(OWN + "n")) - 1
    return few.unionAll(many).withColumn(out, F.explode(F.sequence(F.col(first), last))).drop(first, OWN + "n")
