"""Sharding by sampled splitters.

Every record has a key (here a hash of its text, so equal texts are
neighbours) and a size.  A size-weighted sample of the keys is drawn, its
quantiles become the boundaries of many fine ranges, and the records are
range-partitioned by them.  One exact aggregate gives each range's bytes and
rows; a range with more than its share of bytes or of rows, such as one key that
a third of the records carry, is subdivided by the records' own hashes until each
part is near the share.  Consecutive ranges then make up a shard of near equal bytes,
and a record's slot is its rank in its range plus the rows before the range.

The law is ``bytes``.  Ranges hold ``1 / (shards * RANGES_PER_SHARD)`` of all
bytes, so a shard is off its share by about that much, or by its largest
record.

What reaches the driver is bounded: the sample (about ``SAMPLE_PER_RANGE``
keys a range) and one row for each range.  Ranks are taken within ranges, so
no window holds more than about a range's rows.

Cases: a null text has no bytes and size 1; equal texts share a key and stay
together unless their range is subdivided; null or repeated ids are placed
row by row; with fewer records than shards some shards stay empty; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import OWN, staged, text_or_empty

N_SHARDS = 8
RANGES_PER_SHARD = 256
SAMPLE_PER_RANGE = 24
OVERFULL = 1.5


def _uniform(c: Column) -> Column:
    """A number in [0, 1) from a 64-bit hash."""
    return (F.shiftrightunsigned(c, 11).cast("double")) / float(1 << 53)


def _splitters(keys: DataFrame, total: int, n_ranges: int, sample_per_range: int) -> list[int]:
    """Quantile boundaries of a sample in which a record's weight is its size:
    a record of size s is drawn round(s / step) times, at least in expectation."""
    step = max(1.0, total / (n_ranges * sample_per_range))
    draws = F.floor(F.col("size") / step + _uniform(F.xxhash64("rid", F.lit(11)))).cast("int")
    sample = keys.select("key", draws.alias("w")).filter("w > 0").groupBy("key").agg(F.sum("w").alias("w")).collect()
    if not sample:
        return []
    pairs = np.array(sorted((r.key, r.w) for r in sample), dtype=np.int64)
    cum = np.cumsum(pairs[:, 1])
    at = np.searchsorted(cum, cum[-1] * np.arange(1, n_ranges) / n_ranges, side="left")
    return sorted({int(k) for k in pairs[np.minimum(at, len(pairs) - 1), 0]})


def _range_of(key: Column, splitters: list[int]) -> Column:
    """How many splitters are at or below ``key``: a binary search over a
    constant array, as a fold over the powers of two."""
    if not splitters:
        return F.lit(0)
    n = len(splitters)
    bounds = F.split(F.lit(",".join(map(str, splitters))), ",").cast("array<bigint>")
    powers = [1 << b for b in range(n.bit_length() - 1, -1, -1)]

    def search(b: Column) -> Column:
        return F.aggregate(F.array(*[F.lit(p) for p in powers]), F.lit(0), lambda at, p: F.when(
            (at + p <= n) & (F.get(b, at + p - 1) <= key), at + p).otherwise(at))

    return F.transform(F.array(bounds), search)[0]


def shard_records(records: DataFrame, n_shards: int = N_SHARDS, ranges_per_shard: int = RANGES_PER_SHARD,
                  sample_per_range: int = SAMPLE_PER_RANGE) -> DataFrame:
    """Add ``shard`` and ``slot`` to a stored table with the columns ``rid``
    (unique), ``key`` and ``size``."""
    total = records.agg(F.sum("size").alias("n")).first().n or 0
    n_ranges = n_shards * ranges_per_shard
    share = max(1.0, total / n_ranges)
    splitters = _splitters(records, total, n_ranges, sample_per_range)
    ranged = records.withColumn(OWN + "range", _range_of(F.col("key"), splitters))
    sizes = ranged.groupBy(OWN + "range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    row_share = max(1.0, sum(r.rows for r in sizes) / n_ranges)
    shares = {r[0]: max(r.bytes / share, r.rows / row_share) for r in sizes}
    parts = {k: math.ceil(n) for k, n in shares.items() if n > OVERFULL}
    own = F.lit(0)
    if parts:
        n_parts = F.transform(F.array(F.from_json(F.lit("{" + ",".join(f'"{k}":{v}' for k, v in parts.items()) + "}"),
                                                  "map<string,int>")),
                              lambda m: F.element_at(m, F.col(OWN + "range").cast("string")))[0]
        own = F.coalesce(F.floor(_uniform(F.xxhash64("rid")) * n_parts).cast("int"), F.lit(0))
    cells = staged(ranged.withColumn(OWN + "part", own), "shard-cells")
    counted = sorted(cells.groupBy(OWN + "range", OWN + "part").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect())
    layout, before, rows = [], 0, [0] * n_shards
    for r, part, n_bytes, n_rows in counted:
        shard = min(n_shards - 1, int((before + n_bytes / 2) * n_shards / max(1, total)))
        layout.append((r, part, shard, rows[shard]))
        rows[shard] += n_rows
        before += n_bytes
    spark = records.sparkSession
    cell = [OWN + "range", OWN + "part"]
    places = spark.createDataFrame(layout, f"{cell[0]} int, {cell[1]} int, shard int, {OWN}first long")
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("key", "rid"))
    # One row for each range: at most n_ranges and twice as many parts again.
    placed = cells.withColumn(OWN + "rank", rank).join(F.broadcast(places), cell)
    return placed.withColumn("slot", F.col(OWN + "first") + F.col(OWN + "rank") - 1)


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = N_SHARDS) -> DataFrame:
    """One row per document: size, checksum, law, shard and slot."""
    raw = text_or_empty(text_col).cast("binary")
    records = staged(docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias(OWN + "id"),
        F.xxhash64(text_or_empty(text_col)).alias("key"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32")), "shard-records")
    return shard_records(records, n_shards).select(
        F.col(OWN + "id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``docs`` as one folder per shard, sorted by slot within files.
    ``placed`` has a row for each id; ids are unique here."""
    out = docs.join(placed.select(id_col, "shard", "slot"), id_col)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
