"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is short and a document may be long, so their Jaccard similarity
says little.  Items are therefore partitioned by size: class ``j`` holds the
items of ``2**j`` to ``2**(j+1) - 1`` shingles.  For each class every
document is seen as overlapping windows of ``2**(j+2)`` shingles, one
starting every ``2**(j+1)``, so an item's passage lies within one window
whatever the document's length.  An item with at least ``threshold`` of its
shingles there has a Jaccard similarity with that window above a bound that
is the same in every class; the number of one-row bands is set so that the
chance to miss such a window is below ``MISS``.  The bound needs ``2**j``
distinct shingles.  An item that repeats itself and has fewer is looked up
exactly: a document that holds ``threshold`` of its distinct shingles holds
one of any ``distinct - threshold * distinct + 1`` of them, and so many are
searched among all shingles.  Candidates are verified by
exact containment: the share of the item's distinct shingles that the whole
document holds.

The documents are scanned once where they lie, without a shuffle; windows,
signatures and verification live within a task and a document.  The items
are sent to the tasks in blocks of at most ``BLOCK_BYTES`` of text, one scan
of the documents for each block, so the memory for them has a fixed bound.

Cases: null and empty texts have no shingles and match nothing, as item or
document; a text of one to four words has one shingle, all its words; a null
id is carried; repeated documents or items give a row each; an empty table
on either side gives no rows; extra columns are ignored by ``contaminated``
and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlake.llm.common import text_or_empty, with_code
from emberlake.llm.text import SHINGLE_WORDS, chunks, distinct_shingles, mix, shingles, text_bytes, words

THRESHOLD = 0.8
MISS = 1e-4
BLOCK_BYTES = 8 << 20


def bands_for(threshold: float, miss: float = MISS) -> int:
    """One-row bands for the least Jaccard similarity of an item with a
    window that holds ``threshold`` of it (the smallest item of a class)."""
    least = threshold / (5 - threshold)
    return math.ceil(math.log(miss) / math.log(1 - least))


@dataclass
class SizeClass:
    """The items of one size class: for each band, sorted minima and items."""

    stride: int
    minima: list[np.ndarray] = field(default_factory=list)
    items: list[np.ndarray] = field(default_factory=list)
    seen: list[np.ndarray] = field(default_factory=list)  # a bitmap of the minima's low bits


@dataclass
class ItemIndex:
    """Distinct sorted shingles of each item, the size classes, and the
    looked-up shingles of the items that repeat themselves."""

    shingles: list[np.ndarray]
    multipliers: np.ndarray
    classes: list[SizeClass]
    looked_up: np.ndarray
    looked_up_items: np.ndarray
    looked_up_seen: np.ndarray  # a bitmap of the low bits


_LOW = np.uint64(0xFFFF)


def build_index(texts: pa.Array, threshold: float) -> ItemIndex:
    raw, offsets = text_bytes(texts)
    h, r = shingles(words(raw, offsets))
    lengths = np.bincount(r, minlength=len(texts))
    dh, dr, _ = distinct_shingles(h, r)
    sets = np.split(dh, np.cumsum(np.bincount(dr, minlength=len(texts)))[:-1]) if len(texts) else []
    n_bands = bands_for(threshold)
    multipliers = mix(np.arange(1000, 1000 + n_bands, dtype=np.uint64)) | np.uint64(1)
    classes = []
    size = np.zeros(len(texts), dtype=np.int64)
    size[lengths > 0] = np.floor(np.log2(lengths[lengths > 0])).astype(np.int64)
    n_distinct = np.array([len(x) for x in sets], dtype=np.int64)
    banded = (lengths > 0) & (n_distinct >= 1 << size)
    for j in np.unique(size[banded]):
        of = np.flatnonzero(banded & (size == j))
        c = SizeClass(stride=2 << int(j))
        for a in multipliers:
            least = np.array([(sets[i] * a).min() for i in of], dtype=np.uint64)
            order = np.argsort(least, kind="stable")
            seen = np.zeros(1 << 16, dtype=bool)
            seen[least & _LOW] = True
            c.minima.append(least[order])
            c.items.append(of[order])
            c.seen.append(seen)
        classes.append(c)
    repeating = np.flatnonzero((lengths > 0) & ~banded)
    enough = [sets[i][:len(sets[i]) - max(1, math.ceil(threshold * len(sets[i]) - 1e-9)) + 1] for i in repeating]
    looked_up = np.concatenate([np.zeros(0, dtype=np.uint64), *enough])
    order = np.argsort(looked_up, kind="stable")
    seen = np.zeros(1 << 16, dtype=bool)
    seen[looked_up & _LOW] = True
    of = np.repeat(repeating, [len(x) for x in enough])
    return ItemIndex(sets, multipliers, classes, looked_up[order], of[order], seen)


def _windows(rows: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block starts, the row of each block, and whether the next block
    belongs to the same row.  Shingles are in row order."""
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    place = np.arange(len(rows)) - np.repeat(first, np.diff(np.append(first, len(rows))))
    starts = np.flatnonzero(place % stride == 0)
    block_rows = rows[starts]
    return starts, block_rows, np.append(block_rows[1:] == block_rows[:-1], False)


def _meeting(keys: np.ndarray, items: np.ndarray, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distinct (row, item) pairs of equal values and sorted keys."""
    left = np.searchsorted(keys, values, side="left")
    n = np.searchsorted(keys, values, side="right") - left
    at = np.repeat(left - np.cumsum(n) + n, n) + np.arange(n.sum())
    return np.unique(np.stack([np.repeat(rows, n), items[at]], axis=1), axis=0)


def candidates(index: ItemIndex, h: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distinct (row, item) pairs some window of the row shares a minimum
    with, or whose row has a looked-up shingle."""
    found = [np.zeros((0, 2), dtype=np.int64)]
    if len(h) == 0:
        return found[0]
    cuts = [_windows(rows, c.stride) for c in index.classes]
    for band, a in enumerate(index.multipliers):
        values = h * a
        for c, (starts, block_rows, joined) in zip(index.classes, cuts, strict=True):
            least = np.minimum.reduceat(values, starts)
            window = least.copy()
            np.minimum(least[:-1], least[1:], out=window[:-1], where=joined[:-1])
            hit = np.flatnonzero(c.seen[band][window & _LOW])
            if not len(hit):
                continue
            found.append(_meeting(c.minima[band], c.items[band], window[hit], block_rows[hit]))
    hit = np.flatnonzero(index.looked_up_seen[h & _LOW])
    if len(hit):
        found.append(_meeting(index.looked_up, index.looked_up_items, h[hit], rows[hit]))
    return np.unique(np.concatenate(found), axis=0)


def verified(index: ItemIndex, h: np.ndarray, rows: np.ndarray, pairs: np.ndarray,
             threshold: float) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, shared shingles, item's shingles) of the true matches."""
    last, held = -1, None
    for row, item in pairs.tolist():
        if row != last:
            lo, hi = np.searchsorted(rows, [row, row + 1])
            last, held = row, np.unique(h[lo:hi])
        wanted = index.shingles[item]
        at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
        shared = int((held[at] == wanted).sum())
        if shared >= threshold * len(wanted):
            yield row, item, shared, len(wanted)


def _search(index: ItemIndex, column: pa.Array, threshold: float) -> list[tuple[int, int, int, int]]:
    raw, offsets = text_bytes(column)
    out = []
    for lo, hi in chunks(offsets):
        h, rows = shingles(words(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]))
        pairs = candidates(index, h, rows)
        out.extend((lo + row, *rest) for row, *rest in verified(index, h, rows, pairs, threshold))
    return out


def _blocks(items: DataFrame, id_col: str, text_col: str, threshold: float) -> Iterator[tuple[pa.Array, object]]:
    """(ids, broadcast index) of each block of the items."""
    spark = items.sparkSession
    picked = items.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    total = picked.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    n_blocks = max(1, math.ceil(total / BLOCK_BYTES))
    for b in range(n_blocks):
        block = picked if n_blocks == 1 else picked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == b)
        rows = block.toArrow()
        ids, texts = rows["id"].combine_chunks(), rows["text"].combine_chunks()
        if len(ids):
            yield ids, spark.sparkContext.broadcast(build_index(texts, threshold))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per (document, item) whose containment reaches ``threshold``."""
    spark = docs.sparkSession
    with_code(spark)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    item_type = items.schema[item_col].dataType
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField(item_col, item_type),
                           T.StructField("shared", T.LongType()), T.StructField("item_shingles", T.LongType()),
                           T.StructField("containment", T.DoubleType())])
    out = spark.createDataFrame([], schema)
    for ids, index in _blocks(items, item_col, item_text_col, threshold):
        def search(batches: Iterator[pa.RecordBatch], ids=ids, index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = _search(index.value, batch.column(1), threshold)
                row, item, shared, n = (np.array(x, dtype=np.int64) for x in zip(*hits, strict=True)) if hits else [
                    np.zeros(0, np.int64)] * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), ids.take(pa.array(item)), pa.array(shared), pa.array(n),
                     pa.array(shared / np.maximum(n, 1))], names=schema.names)

        out = out.unionAll(source.mapInArrow(search, schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item; all their columns."""
    with_code(docs.sparkSession)
    at = docs.columns.index(text_col)
    for _, index in _blocks(items, item_col, item_text_col, threshold):
        def keep(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[row for row, *_ in _search(index.value, batch.column(at), threshold)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _oracle_shingles(name: str, id_col: str, source: str) -> str:
    return f"""
{name}_w AS (SELECT {id_col}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
  '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM {source}),
{name}_s AS (SELECT DISTINCT {id_col}, CASE WHEN len(w) < {SHINGLE_WORDS} THEN w ELSE w[i : i + {SHINGLE_WORDS - 1}] END AS s
  FROM (SELECT {id_col}, w, unnest(range(1, greatest(2, len(w) - {SHINGLE_WORDS - 2}))) AS i FROM {name}_w WHERE len(w) > 0))"""


ORACLE = f"""
WITH {_oracle_shingles('d', 'doc_id', 'documents')}, {_oracle_shingles('b', 'item_id', 'benchmark')},
n AS (SELECT item_id, count(*) AS item_shingles FROM b_s GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS shared FROM d_s JOIN b_s USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, item_shingles, CAST(shared AS DOUBLE) / item_shingles AS containment
FROM m JOIN n USING (item_id) WHERE shared >= {THRESHOLD}e0 * item_shingles
"""
