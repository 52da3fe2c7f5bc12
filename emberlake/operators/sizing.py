"""Size-checked broadcast and lineage cuts through the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.session import scratch_path

# Row bound under which a materialised side is broadcast.  The sides checked
# here are climate records (< 200 bytes a row), so the bound keeps a
# broadcast under ~50 MB; anything above it is left to the planner
# (sort-merge, with AQE skew splitting).
BROADCAST_MAX_ROWS = 250_000


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor recomputes from the written files, not
    from the source scan) and gives later size checks exact statistics.
    """
    path = scratch_path(df.sparkSession, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only when the side is proven small by counting it.

    Call on a materialised (cheap to count) side.  Above the bound the side
    is returned unhinted and the planner shuffles both sides.
    """
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df
