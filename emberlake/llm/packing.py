"""Conflict-constrained best-fit packing.

Documents are cut into pieces of at most ``CAPACITY`` tokens (words); pieces
go into bins of that capacity.  A bin carries bitmaps of the sources and the
duplicate clusters in it, and a piece fits a bin only if neither bit is set.
Pieces come longest first; bins are ordered by residual space, and the
successor search goes from the smallest sufficient residual upwards until it
meets a compatible bin, so each piece takes the tightest compatible bin; else
it opens one.

The pieces of one packing are dealt by hash into independent groups of about
``GROUP_PIECES``, each packed in its own task: no bin spans two groups, a hot
source is spread over all of them, and the number of groups grows with the
input.  Full pieces fill a bin alone and are never searched.  Only ids,
lengths and hashes reach the tasks, not texts.

The search finds the successor with a table of counts, for each of the
``COMMON_SOURCES`` most frequent sources of a group and each residual, of the open
bins without that source.  A bin's bitmap has a bit for each of these; its
other sources are a set of their own, and a piece of such a source passes over
at most as many bins as its source has pieces.  So every source counts, and the
tightest compatible bin is found whatever their number.  A bin's cluster
bitmap is the set of its clusters' hashes, as a bin holds few.  At most one
piece of a source in a bin means at least as many bins as the commonest
source has pieces.

Cases: a null or empty text has no tokens and makes one piece of length 0; a
null source or cluster is a value of its own, so two such pieces conflict
like any others; repeated rows are packed row by row; ties go by row number; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import OWN, SPACE_CLASS, staged, text_or_empty, with_code

CAPACITY = 2048
GROUP_PIECES = 20_000
COMMON_SOURCES = 256
WORD = f"[^{SPACE_CLASS}]+"


class OpenBins:
    """Bins of one group, ordered by residual.  Sources are numbers, the
    ``n_common`` first of them the most frequent ones."""

    def __init__(self, capacity: int, n_common: int):
        # Bins without the source, by residual; the last row counts all bins.
        self.free = np.zeros((n_common + 1, capacity + 1), dtype=np.int32)
        self.at: list[dict[int, dict[int, None]]] = [{} for _ in range(capacity + 1)]  # bitmap -> bins in order
        self.residual: list[int] = []
        self.bitmaps: list[int] = []
        self.others: list[set[int]] = []
        self.clusters: list[set[int]] = []
        self.capacity, self.n_common = capacity, n_common
        self.absent: dict[int, np.ndarray] = {}

    def _absent(self, bitmap: int) -> np.ndarray:
        if bitmap not in self.absent:
            self.absent[bitmap] = np.array([1 - (bitmap >> s & 1) for s in range(self.n_common + 1)], dtype=np.int32)
        return self.absent[bitmap]

    def _link(self, b: int, sign: int) -> None:
        r, bitmap = self.residual[b], self.bitmaps[b]
        self.free[:, r] += sign * self._absent(bitmap)
        if sign > 0:
            self.at[r].setdefault(bitmap, {})[b] = None
        else:
            same = self.at[r][bitmap]
            del same[b]
            if not same:
                del self.at[r][bitmap]

    def find(self, length: int, source: int, cluster: int) -> int:
        """The tightest bin with room and neither conflict, or -1."""
        row = min(source, self.n_common)
        for r in np.flatnonzero(self.free[row, length:]):
            for bitmap, bins in self.at[length + int(r)].items():
                if not bitmap >> row & 1:
                    for b in bins:
                        if cluster not in self.clusters[b] and source not in self.others[b]:
                            return b
        return -1

    def put(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Place a piece; returns (bin, offset in it)."""
        b = self.find(length, source, cluster)
        if b < 0:
            b = len(self.residual)
            self.residual.append(self.capacity)
            self.bitmaps.append(0)
            self.others.append(set())
            self.clusters.append(set())
        else:
            self._link(b, -1)
        offset = self.capacity - self.residual[b]
        self.residual[b] -= length
        if source < self.n_common:
            self.bitmaps[b] |= 1 << source
        else:
            self.others[b].add(source)
        self.clusters[b].add(cluster)
        self._link(b, 1)
        return b, offset


def pack_group(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Best fit for one group: columns rid, piece, length, source, cluster."""
    pieces = pieces.sort_values(["length", "rid", "piece"], ascending=[False, True, True], kind="stable")
    rows = pieces.groupby("source").size().reset_index(name="n").sort_values(["n", "source"], ascending=[False, True])
    source = pieces["source"].map({s: i for i, s in enumerate(rows["source"])})
    bins = OpenBins(capacity, min(COMMON_SOURCES, len(rows)))
    placed = [bins.put(n, s, c) for n, s, c in
              zip(pieces["length"].tolist(), source.tolist(), pieces["cluster"].tolist(), strict=True)]
    local = np.array(placed, dtype=np.int64).reshape(-1, 2)
    return pieces.assign(bin=local[:, 0], offset=local[:, 1])


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``bin`` and ``offset`` to a stored table of pieces (rid, id,
    piece, length, source, cluster; ``length`` at most ``capacity``)."""
    with_code(pieces.sparkSession)
    loose = pieces.filter(F.col("length") < capacity)
    n_groups = max(1, math.ceil(loose.count() / group_pieces))
    group = F.pmod(F.xxhash64("rid", "piece"), F.lit(n_groups))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema]
    schema = ", ".join([*fields, "bin_group long", "bin long", "offset long"])

    def pack(key: tuple, group_rows: pd.DataFrame) -> pd.DataFrame:
        out = pack_group(group_rows.drop(columns="bin_group"), capacity)
        return out.assign(bin_group=key[0])[[*group_rows.columns.drop("bin_group"), "bin_group", "bin", "offset"]]

    packed = loose.withColumn("bin_group", group).groupBy("bin_group").applyInPandas(pack, schema)
    full = pieces.filter(F.col("length") == capacity).select(
        "*", F.concat_ws("-", F.lit("full"), F.col("rid").cast("string"), F.col("piece").cast("string")).alias("bin"),
        F.lit(0).cast("long").alias("offset"))
    name = F.concat_ws("-", F.col("bin_group").cast("string"), F.col("bin").cast("string"))
    return packed.withColumn("bin", name).drop("bin_group").unionByName(full)


def document_cluster(text: Column) -> Column:
    """Duplicate cluster of a text: a hash of its words in lower case."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(text), f"[{SPACE_CLASS}]+", " ")))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                   cluster: Column | None = None, capacity: int = CAPACITY,
                   group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: document, piece number, its token range, bin and
    offset in the bin."""
    text = text_or_empty(text_col)
    sized = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias(OWN + "id"),
        F.regexp_count(text, F.lit(WORD)).alias("n"),
        F.xxhash64(F.col(source_col).cast("string"), F.col(source_col).isNull()).alias("source"),
        (cluster if cluster is not None else document_cluster(text)).alias("cluster"))
    last = F.greatest(F.lit(0), F.ceil(F.col("n") / capacity) - 1).cast("int")
    pieces = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), last))).withColumn(
        "length", F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity).cast("int"))
    pieces = staged(pieces.select("rid", OWN + "id", "piece", "length", "source", "cluster"), "pack-pieces")
    start = (F.col("piece") * capacity).cast("long")
    return pack_pieces(pieces, capacity, group_pieces).select(
        F.col(OWN + "id").alias(id_col), "piece", start.alias("first_token"),
        (start + F.col("length")).alias("end_token"), "bin", "offset")
