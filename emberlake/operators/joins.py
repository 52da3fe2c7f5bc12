"""Left-outer joins whose preserved side is the small one.

``small LEFT JOIN big`` can only broadcast ``big`` (the build side of a
left-outer join is the non-preserved side), so Spark shuffles both sides
on the key and every row of a hot key meets in one task; AQE cannot split
the skew either, as it may only split the preserved side.  Written as an
inner join (either side may be broadcast, both may be split) plus the
small rows whose key never occurs in ``big`` (an anti join against the
pre-aggregated distinct keys), the big side is never gathered by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from emberlake.operators.sizing import broadcast_if_small


def left_join_small(small: DataFrame, big: DataFrame, keys: list[str],
                    check_size: bool = True, present: DataFrame | None = None) -> DataFrame:
    """``small LEFT JOIN big USING (keys)``; ``small`` should be materialised
    (it is read twice and counted when ``check_size``).  ``present`` may give
    the distinct keys of ``big`` when they are already known."""
    side = broadcast_if_small(small) if check_size else small
    matched = big.join(side, keys, "inner")
    if present is None:
        present = big.select(*keys).distinct()
    lonely = small.join(present, keys, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)
