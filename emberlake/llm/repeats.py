"""Removal of passages that an earlier document has, by sparse suffix sorting.

A byte goes if a string of ``LENGTH`` (50) bytes over it also starts in a
document of smaller id.  Sorting every suffix of a corpus moves each byte
many times; here only the suffixes that can matter meet.  Every window of 50
bytes has an anchor that depends on the window alone (``suffixes.py``), so
equal windows share an anchor, and the work goes in three steps over stored
chunks of documents:

1. Each chunk sends, for each distinct (anchor, region) of its runs of
   windows, short hashes and the least document; the tasks that own a range
   of anchors find regions with an earlier owner (all of it goes) and
   anchors whose regions differ (``open``: a part may go).
2. The chunks send the bytes of their open regions, once each, with the least
   document.  The owners sort those suffixes by their bytes, a word of eight at
   a time and only as far as they are equal.  The answer is a bit for each window.
3. Each chunk marks the bytes of its documents and hashes what is left.

Chunks hold about ``CHUNK_BYTES`` of text.  What a chunk sends of one anchor
is bounded: with more than ``HOT_REGIONS`` regions it sends one hot mark, and
the windows of a hot anchor go to owners by their own hashes, once a chunk.
So an owner gets a bounded share from each chunk, and a passage in a third of
all documents is spread like any other.  Steps exchange packed arrays, one
row for each chunk and owner.

Cases: a null text counts as empty; documents with one id are one owner and
remove nothing from each other; a null id sorts after all others; texts below
50 bytes lose nothing; ids are whole numbers; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import staged, text_or_empty, with_code
from emberlake.llm.suffixes import LENGTH, REGION, anchor_runs, repeated_windows
from emberlake.llm.text import chunks, text_bytes

CHUNK_BYTES = 1 << 20
OWNER_BYTES = 12 << 20  # text for each owner of anchors
HOT_REGIONS = 8
NO_ID = np.int64((1 << 63) - 1)
FIRST, OPEN, HOT = 1, 2, 4
_CHUNK_SCHEMA = "chunk long, ids array<long>, sizes array<long>, data binary"
_LOW24 = np.uint64((1 << 24) - 1)


def chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents packed into chunks, one row each, their text compressed."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = TaskContext.get().partitionId() << 33
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for lo, hi in chunks(offsets, CHUNK_BYTES):
                sizes = np.diff(offsets[lo:hi + 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n]), pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(0).slice(lo, hi - lo)),
                     pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), pa.array(sizes)),
                     pa.array([press.compress(raw[offsets[lo]:offsets[hi]].tobytes())], pa.binary())],
                    names=["chunk", "ids", "sizes", "data"])
                n += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t"))
    return rows.mapInArrow(pack, _CHUNK_SCHEMA)


@dataclass
class Chunk:
    """One chunk's documents, runs of windows and entries for the owners.

    An entry is a distinct (anchor, region), or a whole anchor if it is hot
    here; entries are in the order of owners and keys.
    """

    raw: np.ndarray
    offsets: np.ndarray
    ids: pa.Array
    rank: np.ndarray

    @classmethod
    def load(cls, ids: pa.Array, sizes: pa.Array, data: bytes) -> Chunk:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
        offsets = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))]).astype(np.int64)
        return cls(raw, offsets, ids, ids.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64))

    def enter(self, owners: int, hot_regions: int) -> None:
        runs = anchor_runs(self.raw, self.offsets)
        rank = self.rank[runs.doc]
        owner = ((runs.h & _LOW24) % np.uint64(owners)).astype(np.int64)
        # By owner and the hash bits it does not imply; runs alike in both by all keys.
        key = (owner.astype(np.uint64) << np.uint64(40)) | (runs.h >> np.uint64(24))
        order = np.argsort(key, kind="stable")
        key = key[order]
        alike = np.append(False, key[1:] == key[:-1])[:len(key)]
        some = np.flatnonzero(alike | np.append(alike[1:], False)[:len(key)])
        tied = order[some]
        order[some] = tied[np.lexsort((rank[tied], runs.region[tied], runs.h[tied], key[some]))]
        self.runs, self.order = runs, order
        h, region = runs.h[order], runs.region[order]
        new_h = np.append(True, h[1:] != h[:-1])[:len(h)]
        new = new_h | np.append(True, region[1:] != region[:-1])[:len(h)]
        anchor_of = np.cumsum(new_h) - 1
        hot_here = (np.bincount(anchor_of[new], minlength=anchor_of[-1] + 1 if len(h) else 0) > hot_regions)[anchor_of] \
            if len(h) else new
        new = np.where(hot_here, new_h, new)
        self.entry = np.cumsum(new) - 1  # of each run, in order
        head = np.flatnonzero(new)
        self.h, self.region = h[head], region[head]
        self.hot_here = hot_here[head]
        self.rank_of_run = rank[order]
        self.least = np.minimum.reduceat(self.rank_of_run, head) if len(head) else np.zeros(0, np.int64)
        self.owner = owner[order][head]

    def by_owner(self) -> Iterator[tuple[int, slice]]:
        head = np.flatnonzero(np.append(True, self.owner[1:] != self.owner[:-1])[:len(self.owner)])
        for lo, hi in zip(head, np.append(head[1:], len(self.owner)), strict=True):
            yield int(self.owner[lo]), slice(int(lo), int(hi))

    def answers(self, replies: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(len(self.owner), dtype=np.uint8)
        for owner, part in self.by_owner():
            out[part] = np.frombuffer(replies[owner], dtype=np.uint8)
        return out

    def open_records(self, answer: np.ndarray, owners: int):
        """The records of step 2: (owner, first byte, length, anchor offset,
        rank), and for each (run, window) of a record the record's number.

        A first, open region is one record.  The windows of hot anchors are
        records of their own, one for each distinct window.
        """
        a = answer[self.entry]
        runs = self.runs
        first = runs.first[self.order]
        windows, anchor = runs.windows[self.order], runs.anchor[self.order]
        is_head = np.append(True, self.entry[1:] != self.entry[:-1])[:len(self.entry)]
        hot = (a & HOT) > 0
        # A region that is removed for every document here needs no answer.
        plain = np.flatnonzero(is_head & ~hot & ((a & (FIRST | OPEN)) == (FIRST | OPEN)))
        out = [(self.owner[self.entry[plain]], first[plain], windows[plain] + LENGTH - 1,
                anchor[plain] - first[plain], self.rank_of_run[plain])]
        hot_runs = np.flatnonzero(hot)
        w = windows[hot_runs]
        run = np.repeat(hot_runs, w)
        at = np.repeat(first[hot_runs], w) + np.arange(len(run)) - np.repeat(np.cumsum(w) - w, w)
        number = np.zeros(0, dtype=np.int64)
        if len(run):
            text = self.raw[at[:, None] + np.arange(LENGTH)]
            _, head, number = np.unique(_sortable(text), return_index=True, return_inverse=True)
            least = np.full(len(head), NO_ID)
            np.minimum.at(least, number, self.rank_of_run[run])
            digest = np.array([int.from_bytes(hashlib.blake2b(text[i].tobytes(), digest_size=7).digest(), "little") for i in head],
                              dtype=np.int64)
            out.append((digest % owners, at[head], np.full(len(head), LENGTH), (anchor[run] - at)[head], least))
            number = number + len(plain)
        owner, start, length, offset, rank = (np.concatenate(x) for x in zip(*out, strict=True))
        sent = np.argsort(owner, kind="stable")
        return (owner[sent], start[sent], length[sent], offset[sent], rank[sent]), sent, plain, (run, at, number)


def _sortable(text: np.ndarray) -> np.ndarray:
    """Rows of LENGTH bytes as structured big-endian words, for np.unique."""
    wide = np.zeros((len(text), -(-text.shape[1] // 8) * 8), dtype=np.uint8)
    wide[:, :text.shape[1]] = text
    kinds = np.dtype([(f"w{i}", ">u8") for i in range(wide.shape[1] // 8)])
    return wide.view(kinds).ravel()


def _rows(table: pa.Table) -> Iterator[dict]:
    for batch in table.to_batches():
        yield from batch.to_pylist()


def _chunk_of(table: pa.Table) -> Chunk:
    return Chunk.load(table["ids"].combine_chunks().flatten(), table["sizes"].combine_chunks().flatten(), table["data"][0].as_py())


def _send_anchors(owners: int, hot_regions: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                c = _chunk_of(row)
                c.enter(owners, hot_regions)
                n = row["chunk"][0].as_py()
                out: dict[str, list] = {"owner": [], "chunk": [], "h": [], "region": [], "hot": [], "rank": []}
                low = int(c.least.min()) if len(c.least) else 0
                for owner, part in c.by_owner():
                    delta = c.least[part].astype(np.uint64) - np.uint64(low % (1 << 64))
                    small = np.min_scalar_type(int(delta.max()))
                    out["owner"].append(owner)
                    out["chunk"].append(n)
                    # the 40 bits of the anchor hash that the owner does not imply
                    out["h"].append(np.ascontiguousarray((c.h[part] >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]).tobytes())
                    out["region"].append((c.region[part] >> np.uint64(32)).astype(np.uint32).tobytes())
                    out["hot"].append(np.packbits(c.hot_here[part]).tobytes())
                    out["rank"].append(low.to_bytes(8, "little", signed=True) + delta.astype(small).tobytes())
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                    ("owner", pa.int64()), ("chunk", pa.int64()), ("h", pa.binary()), ("region", pa.binary()),
                    ("hot", pa.binary()), ("rank", pa.binary())]))

    return send


def _own_anchors(table: pa.Table) -> pa.Table:
    """Step 1 for one owner: FIRST, OPEN and HOT bits of each entry."""
    rows = list(_rows(table))
    sizes = [len(r["region"]) // 4 for r in rows]
    n = sum(sizes)
    h = np.zeros((n, 8), dtype=np.uint8)
    h[:, :5] = np.frombuffer(b"".join(r["h"] for r in rows), dtype=np.uint8).reshape(-1, 5)
    h = h.view(np.uint64).ravel()
    region = np.frombuffer(b"".join(r["region"] for r in rows), dtype=np.uint32)
    hot = np.concatenate([np.unpackbits(np.frombuffer(r["hot"], np.uint8), count=m) for r, m in zip(rows, sizes, strict=True)]).astype(bool)
    ranks = []
    for r, m in zip(rows, sizes, strict=True):
        width = (len(r["rank"]) - 8) // m
        delta = np.frombuffer(r["rank"], dtype=f"u{width}", offset=8).astype(np.uint64)
        ranks.append((delta + np.uint64(int.from_bytes(r["rank"][:8], "little", signed=True) % (1 << 64))).view(np.int64))
    rank = np.concatenate(ranks)
    order = np.lexsort((rank, region, h))
    ho, ro, ko = h[order], region[order], rank[order]
    new_h = np.append(True, ho[1:] != ho[:-1])
    new_r = new_h | np.append(True, ro[1:] != ro[:-1])
    group, cls = np.cumsum(new_h) - 1, np.cumsum(new_r) - 1
    head = np.flatnonzero(new_h)
    n_classes = np.bincount(group[new_r])
    any_hot = np.logical_or.reduceat(hot[order], head)
    several = np.minimum.reduceat(ko, head) != np.maximum.reduceat(ko, head)
    first = ko == ko[np.flatnonzero(new_r)][cls]
    answer = np.zeros(n, dtype=np.uint8)
    answer[order] = (first * FIRST + ((n_classes > 1) & several)[group] * OPEN + any_hot[group] * HOT).astype(np.uint8)
    cuts = np.cumsum([0, *sizes])
    return pa.table({"chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
                     "owner": pa.array([r["owner"] for r in rows], pa.int64()),
                     "answer": pa.array([answer[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})


def _replies(table: pa.Table) -> dict[int, bytes]:
    return {r["owner"]: r["answer"] for r in _rows(table)}


def _send_regions(owners: int, hot_regions: int):
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        c = _chunk_of(left)
        c.enter(owners, hot_regions)
        (owner, start, length, offset, rank), *_ = c.open_records(c.answers(_replies(right)), owners)
        head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[:len(owner)])
        press = zstandard.ZstdCompressor(level=1)
        out: dict[str, list] = {"owner": [], "chunk": [], "data": [], "length": [], "anchor": [], "rank": []}
        for lo, hi in zip(head, np.append(head[1:], len(owner)), strict=True):
            n = length[lo:hi]
            at = np.repeat(start[lo:hi], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out["owner"].append(int(owner[lo]))
            out["chunk"].append(left["chunk"][0].as_py())
            out["data"].append(press.compress(c.raw[at].tobytes()))
            out["length"].append(n.astype(np.uint8).tobytes())
            out["anchor"].append(offset[lo:hi].astype(np.uint8).tobytes())
            out["rank"].append(press.compress(rank[lo:hi].astype(np.int64).tobytes()))
        return pa.Table.from_pydict(out, schema=pa.schema([
            ("owner", pa.int64()), ("chunk", pa.int64()), ("data", pa.binary()), ("length", pa.binary()),
            ("anchor", pa.binary()), ("rank", pa.binary())]))

    return send


def _own_regions(table: pa.Table) -> pa.Table:
    """Step 2 for one owner: the repeated windows of each record."""
    rows = list(_rows(table))
    open_ = zstandard.ZstdDecompressor()
    length = np.frombuffer(b"".join(r["length"] for r in rows), dtype=np.uint8).astype(np.int64)
    anchor = np.frombuffer(b"".join(r["anchor"] for r in rows), dtype=np.uint8).astype(np.int64)
    rank = np.concatenate([np.frombuffer(open_.decompress(r["rank"]), dtype=np.int64) for r in rows])
    flat = np.frombuffer(b"".join(open_.decompress(r["data"]) for r in rows), dtype=np.uint8)
    data = np.zeros((len(length), REGION), dtype=np.uint8)
    data[np.arange(REGION) < length[:, None]] = flat
    masks = repeated_windows(data, length, anchor, rank)
    cuts = np.cumsum([0, *[len(r["length"]) for r in rows]])
    return pa.table({"chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
                     "owner": pa.array([r["owner"] for r in rows], pa.int64()),
                     "answer": pa.array([masks[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())})


def _covered(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, stops, -1)
    return np.cumsum(step)[:n] > 0


def removed_bytes(c: Chunk, answer: np.ndarray, windows_answer: dict[int, bytes], owners: int) -> np.ndarray:
    """Which bytes of the chunk go."""
    (owner, _, length, _, rank), sent, plain, (run, at, number) = c.open_records(answer, owners)
    masks = np.zeros(len(owner), dtype=np.uint32)
    head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[:len(owner)])
    for lo, hi in zip(head, np.append(head[1:], len(owner)), strict=True):
        masks[lo:hi] = np.frombuffer(windows_answer[int(owner[lo])], dtype=np.uint32)
    by_record, rank_of = np.zeros_like(masks), np.zeros_like(rank)
    by_record[sent], rank_of[sent] = masks, rank
    runs, order = c.runs, c.order
    first, windows = runs.first[order], runs.windows[order]
    a, least = answer[c.entry], c.least[c.entry]
    hot = (a & HOT) > 0
    whole = ~hot & ((c.rank_of_run > least) | ((a & FIRST) == 0))
    starts, stops = [first[whole]], [(first + windows + LENGTH - 1)[whole]]
    # A first region's windows count for every run of its least document.
    record_of_entry = np.full(len(c.owner), -1)
    record_of_entry[c.entry[plain]] = np.arange(len(plain))
    record = record_of_entry[c.entry]
    part = np.flatnonzero(~whole & ~hot & (record >= 0))
    mask = by_record[record[part]]
    for w in range(REGION - LENGTH + 1):
        i = part[(mask >> np.uint32(w) & np.uint32(1)) > 0]
        starts.append(first[i] + w)
        stops.append(first[i] + w + LENGTH)
    if len(run):
        gone = (c.rank_of_run[run] > rank_of[number]) | (by_record[number] > 0)
        starts.append(at[gone])
        stops.append(at[gone] + LENGTH)
    return _covered(len(c.raw), np.concatenate(starts), np.concatenate(stops))


def _finish(owners: int, hot_regions: int, with_text: bool):
    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        c = _chunk_of(left)
        c.enter(owners, hot_regions)
        step = right["step"].to_numpy()
        answer = c.answers(_replies(right.filter(pa.array(step == 1))))
        gone = removed_bytes(c, answer, _replies(right.filter(pa.array(step == 2))), owners)
        o = c.offsets
        before = np.concatenate([[0], np.cumsum(gone)])
        edges = gone.copy()
        edges[1:] &= ~gone[:-1]
        inner = o[:-1][o[:-1] < len(gone)]
        edges[inner] = gone[inner]
        spans = np.concatenate([[0], np.cumsum(edges)])
        kept = [c.raw[a:b][~gone[a:b]].tobytes() for a, b in zip(o[:-1], o[1:], strict=True)]
        out = {"id": c.ids, "n_bytes": pa.array(np.diff(o)), "n_removed": pa.array(before[o[1:]] - before[o[:-1]]),
               "n_spans": pa.array(spans[o[1:]] - spans[o[:-1]]),
               "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
        if with_text:
            out["kept"] = pa.array(kept, pa.binary())
        return pa.table(out)

    return finish


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
                   hot_regions: int = HOT_REGIONS) -> DataFrame:
    """One row per document: sizes, removed bytes and runs, the digest of
    what is left and, if asked, those bytes (``kept``)."""
    spark = docs.sparkSession
    with_code(spark)
    packed = staged(chunked(docs, id_col, text_col), "repeat-chunks")
    total = packed.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n")).first().n or 0
    owners = min(1 << 22, max(16, math.ceil(total / OWNER_BYTES)))
    sent = packed.mapInArrow(_send_anchors(owners, hot_regions),
                             "owner long, chunk long, h binary, region binary, hot binary, rank binary")
    reply = "chunk long, owner long, answer binary"
    # As many tasks as owners, so that a task's share stays as it is when the input grows.
    anchors = staged(sent.repartition(owners, "owner").groupBy("owner").applyInArrow(_own_anchors, reply), "repeat-anchors")
    regions = packed.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(
        _send_regions(owners, hot_regions), "owner long, chunk long, data binary, length binary, anchor binary, rank binary")
    windows = staged(regions.repartition(owners, "owner").groupBy("owner").applyInArrow(_own_regions, reply), "repeat-windows")
    both = anchors.withColumn("step", F.lit(1)).unionAll(windows.withColumn("step", F.lit(2)))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    out = packed.groupBy("chunk").cogroup(both.groupBy("chunk")).applyInArrow(_finish(owners, hot_regions, with_text), schema)
    return out.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)
