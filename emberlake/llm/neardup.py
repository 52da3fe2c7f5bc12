"""Near-duplicates by consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of its five-word shingles: the count times an IDF
factor between ``IDF_FLOOR`` and 1.  Improved consistent weighted sampling
draws ``BANDS * ROWS`` samples; two texts agree in a sample with a
probability equal to their weighted Jaccard similarity, and texts that agree
in all rows of a band are candidates.  Verified candidates (similarity of
``THRESHOLD`` or more, computed exactly from both texts) are links, and a
class is a connected component of links and equal texts.

Document frequencies are counted over all documents in ``CELLS`` hashed
cells.  A cell's share of rare shingles is the same at any corpus size, so
rare shingles weigh 1, and those in a large part of the documents weigh
less.  The floor keeps the copies of a very common text similar.

Scale: equal texts are one node, so a group of exact copies costs one row.
Two turns compare the nodes of a bucket with one of its nodes each (the least,
then one outside the bucket's largest component), by a join of pairs of numbers
with the texts; most buckets are then within one component, and done.  The nodes of
those that are not are gathered by bucket, with their texts, and a task finds
the links between components among them, by signatures and then exactly, and
returns a spanning forest: work and rows grow with the bucket rows, as a bucket
has at most ``GROUP_NODES`` nodes and ``GROUP_BYTES`` of text.  A larger bucket has further
turns with leaders, and its nodes then move to ``SUB_KEYS`` smaller
buckets each, of the bucket's own key and three more samples, level by level.  Of two nodes at the
threshold one such level keeps a bucket in common with a probability of 0.76, and they have 7 of
14 buckets in common on average; at the last of ``LEVELS`` levels, where nodes agree
in 21 samples, the nodes only take turns with leaders.  Smaller buckets part some
pairs of a larger one, so the larger buckets that still span components after all this are
compared whole: their nodes fall into blocks, and a task has two blocks (``block_pairs``).  No
pair that shares a bucket is left out; memory stays bounded, and only the work on
a larger bucket whose components do not meet is quadratic.  A signature filter (``least_agreement``
samples; a link at the threshold falls below with a probability under that of
sharing no band) precedes the exact comparison.  The joins read stored tables,
so Spark splits skewed keys at run time.  The frequency table has a fixed size,
and pairs of numbers are broadcast only when counted and few.

Cases: null and empty texts are equal, and one class; a text without words
is linked to equal texts only; one to four words make one shingle; a null
document id sorts after all others in the choice of a class's kept row; of repeated rows
one is kept; an empty table gives an empty result; extra columns are ignored by
``duplicate_classes`` and kept by ``drop_duplicates``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import OWN, staged, text_or_empty, with_code
from emberlake.llm.components import components
from emberlake.llm.text import chunks, mix, shingles, text_bytes, words
from emberlake.operators.sequence import unfold
from emberlake.operators.sizing import broadcast_if_small

THRESHOLD = 0.8
BANDS, ROWS = 14, 3
SAMPLES = BANDS * ROWS
LEADERS = (0, 1)  # leaders of a key in the turns before buckets are gathered; 0: the least node
MORE_LEADERS = (1,)  # the same for larger buckets at each level
GROUP_NODES = 768
GROUP_BYTES = 16 << 20
SUB_KEYS, SUB_ROWS, LEVELS = 2, 3, 6
CELL_BITS = 16
IDF_FLOOR = 0.5
COMMON_SHARE = 0.02  # shingles in at most this share of the documents weigh 1

_C_BITS, _R_BITS, _B_BITS = 18, 14, 16
_H48 = np.uint64((1 << 48) - 1)


def _gamma2_quantiles(bits: int) -> np.ndarray:
    """Quantiles of the Gamma(2, 1) law at the middles of 2**bits steps."""
    p = (np.arange(1 << bits) + 0.5) / (1 << bits)
    lo, hi = np.zeros_like(p), np.full_like(p, 60.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        below = 1 - (1 + mid) * np.exp(-mid) < p
        lo, hi = np.where(below, mid, lo), np.where(below, hi, mid)
    return (lo + hi) / 2


_R = _gamma2_quantiles(_R_BITS).astype(np.float32)
_LN_C = np.log(_gamma2_quantiles(_C_BITS)).astype(np.float32)
_SEEDS = mix(np.arange(5000, 5000 + SAMPLES, dtype=np.uint64)) | np.uint64(1)


def counted_shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(48-bit hash, row, count) of the distinct shingles, in row order.  The
    rows are at most 2**16."""
    h, r = shingles(words(raw, offsets))
    packed = np.sort((r.astype(np.uint64) << np.uint64(48)) | (h >> np.uint64(16)))
    at = np.flatnonzero(np.diff(packed, prepend=~packed[:1]))
    return packed[at] & _H48, (packed[at] >> np.uint64(48)).astype(np.int64), np.diff(np.append(at, len(packed)))


def _parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    raw, offsets = text_bytes(column)
    for lo, hi in chunks(offsets):
        for a in range(lo, hi, 1 << 15):
            b = min(hi, a + (1 << 15))
            yield a, b, *counted_shingles(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


def _cell(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """Number of documents with words, and the hashed document frequencies."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(1 << CELL_BITS, dtype=np.int64), 0
        for batch in batches:
            for *_, h, r, _ in _parts(batch.column(0)):
                n += np.bincount(_cell(h), minlength=len(n))
                total += int(np.count_nonzero(np.diff(r, prepend=-1)))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(n[at], total))], names=["cell", "n"])

    rows = (docs.select(text_or_empty(text_col).alias("t")).mapInArrow(count, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect())  # at most 2**CELL_BITS + 1 rows
    out, total = np.zeros(1 << CELL_BITS, dtype=np.int64), 0
    for cell, n in rows:
        if cell < 0:
            total = n
        else:
            out[cell] = n
    return total, out


def idf_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    share = np.log(max(1, n_docs) / np.maximum(df, 1)) / np.log(1 / COMMON_SHARE)
    return (IDF_FLOOR + (1 - IDF_FLOOR) * np.clip(share, 0, 1)).astype(np.float32)


def signatures(h: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One row of samples for each run of shingles from ``starts``.

    With r and c from Gamma(2, 1) and b uniform, all from the hash, a shingle
    of weight w has t = floor(ln w / r + b) and the value c * exp(-r (t - b + 1));
    the sample is the shingle of least value with its t.
    """
    out = np.empty((len(starts), SAMPLES), dtype=np.uint32)
    ln_w = np.log(weights).astype(np.float32)
    scale = np.float32(1 / (1 << _B_BITS))
    name = (h ^ (h >> np.uint64(21))).astype(np.uint32)
    for k, seed in enumerate(_SEEDS):
        x = h * seed
        x ^= x >> np.uint64(32)
        x *= seed
        x ^= x >> np.uint64(29)
        r = _R[x & np.uint64((1 << _R_BITS) - 1)]
        b = ((x >> np.uint64(_R_BITS)) & np.uint64((1 << _B_BITS) - 1)).astype(np.float32) * scale
        t = np.floor(ln_w / r + b)
        value = _LN_C[x >> np.uint64(64 - _C_BITS)] - r * (t - b + np.float32(1))
        bits = value.view(np.uint32)
        ordered = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))
        sample = name + t.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1)
        key = (ordered.astype(np.uint64) << np.uint64(32)) | sample
        out[:, k] = np.minimum.reduceat(key, starts).astype(np.uint32)
    return out


def signed(docs: DataFrame, id_col: str, text_col: str, idf) -> DataFrame:
    """(id, node, sig) of every document; texts without words have no sig."""
    text = text_or_empty(text_col)
    source = docs.select(F.col(id_col).alias("id"), node_of(text_col).alias("node"), text.alias("t"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, node string, sig array<int>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for batch in batches:
            sizes = np.zeros(batch.num_rows, dtype=np.int64)
            sigs = [np.zeros((0, SAMPLES), dtype=np.uint32)]
            for a, _, h, r, n in _parts(batch.column(2)):
                if len(h):
                    starts = np.flatnonzero(np.diff(r, prepend=-1))
                    sizes[a + r[starts]] = SAMPLES
                    sigs.append(signatures(h, starts, table[_cell(h)] * n.astype(np.float32)))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = pa.array(np.concatenate(sigs).view(np.int32).ravel())
            lists = pa.ListArray.from_arrays(pa.array(ends), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "node", "sig"])

    return source.mapInArrow(sign, schema)


def node_of(text_col: str) -> Column:
    """The identity of a text: 128 bits of its digest."""
    return F.substring(F.sha2(text_or_empty(text_col).cast("binary"), 256), 1, 32)


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (nid, key, ...) whose key has two nodes at least."""
    ends = rows.groupBy("key").agg(F.min("nid").alias("a"), F.max("nid").alias("b")).filter("a < b").select("key")
    return rows.join(staged(ends, "near-shared"), "key")


def bucket_keys(nodes: DataFrame) -> DataFrame:
    """(nid, band, key): the buckets that a node shares with others, from a
    stored table (nid, sig, ...) of nodes."""
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(
        b.alias("band"), F.xxhash64(b, F.slice("sig", b * ROWS + 1, ROWS)).alias("key"))))
    rows = nodes.filter(F.size("sig") > 0).select("nid", band.alias("x")).select("nid", "x.band", "x.key")
    return staged(_shared(rows).select("nid", "band", "key"), "near-keys")


def smaller_keys(rows: DataFrame, nodes: DataFrame, level: int) -> DataFrame:
    """Rows (nid, band, key) under ``SUB_KEYS`` keys each, with ``SUB_ROWS`` more
    samples that no level before has used."""
    def sub(j: int) -> Column:
        first = ROWS + SUB_ROWS * (SUB_KEYS * level + j)
        more = [F.get("sig", (F.col("band") * ROWS + first + i) % SAMPLES) for i in range(SUB_ROWS)]
        return F.xxhash64("key", F.lit(j), *more)

    keyed = rows.join(nodes.select("nid", "sig"), "nid").select(
        "nid", "band", F.explode(F.array(*[sub(j) for j in range(SUB_KEYS)])).alias("key"))
    return staged(_shared(staged(keyed, "near-subkeys")).select("nid", "band", "key"), "near-keys")


def led(keys: DataFrame, turn: int, n_leaders: int) -> tuple[DataFrame, DataFrame]:
    """The rows (nid, first) of nodes and leaders of their key in another
    component, and the rows (nid, band, key) of the keys that are still open.

    ``keys`` are (nid, band, key, root); a key within one component is done.
    With no ``n_leaders`` the leader is the key's least node.  Else leaders are
    drawn from the nodes outside the key's largest component; once there are
    no more of these than leaders, all are drawn, every pair of two
    components has been compared, and the key is done.
    """
    parts = keys.groupBy("key", "root").agg(F.count("*").alias("n"), F.min("nid").alias("least"))
    spans = staged(parts.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("large"), F.sum("n").alias("n"), F.min("least").alias("least"))
        .select("key", F.col("large.root").alias("largest"), (F.col("n") - F.col("large.n")).alias("others"), "least")
        .filter("others > 0"), "near-spans")
    rows = staged(keys.join(spans, "key"), "near-open")
    if not n_leaders:
        leads = rows.filter("nid = least")
    else:
        drawn = F.pmod(F.xxhash64("nid", F.lit(turn)), F.col("others")) < n_leaders
        leads = rows.filter((F.col("root") != F.col("largest")) & drawn)
    leads = staged(leads.select("key", F.col("nid").alias("first"), F.col("root").alias("first_root")), "near-leaders")
    met = rows.join(leads, "key").filter("root != first_root").select("nid", "first")
    return met, rows.filter(F.col("others") > n_leaders).select("nid", "band", "key")


def least_agreement(threshold: float) -> int:
    """The most samples of which a pair at ``threshold`` agrees in fewer with
    a probability below that of sharing no band."""
    miss, below, m = (1 - threshold ** ROWS) ** BANDS, 0.0, 0
    while m < SAMPLES:
        below += math.comb(SAMPLES, m) * threshold ** m * (1 - threshold) ** (SAMPLES - m)
        if below >= miss:
            break
        m += 1
    return m


def agreeing(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose signatures agree in ``least_agreement`` samples."""
    sig_v = nodes.select(F.col("nid").alias("v"), F.col("sig").alias("sig_v"))
    sig_u = nodes.select(F.col("nid").alias("u"), F.col("sig").alias("sig_u"))
    agree = F.aggregate(F.zip_with("sig_v", "sig_u", lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
    return pairs.join(sig_v, "v").join(sig_u, "u").filter(agree >= least_agreement(threshold)).select("v", "u")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after links (v, u) between nodes of different components."""
    if links.isEmpty():
        return roots
    ends = links.join(roots.toDF("v", "a"), "v").join(roots.toDF("u", "b"), "u").select(
        F.col("a").alias("v"), F.col("b").alias("u"))
    merged = staged(components(ends).toDF("root", "least"), "near-merged")
    return staged(roots.join(merged, "root", "left").select("nid", F.coalesce("least", "root").alias("root")), "near-roots")


def node_components(keys: DataFrame, nodes: DataFrame, texts: DataFrame, idf, threshold: float,
                    group_nodes: int | None = None, group_bytes: int | None = None) -> DataFrame:
    """(nid, root) of the nodes with keys: turns with leaders, then the open
    buckets, the larger ones first made smaller."""
    roots = staged(keys.select("nid").distinct().select("nid", F.col("nid").alias("root")), "near-roots")
    group_nodes, group_bytes = group_nodes or GROUP_NODES, group_bytes or GROUP_BYTES
    turn = 0

    def turns(keys: DataFrame, roots: DataFrame, leaders: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
        nonlocal turn
        for n_leaders in leaders:
            met, keys = led(keys.join(roots, "nid"), turn, n_leaders)
            pairs = met.select(F.greatest("nid", "first").alias("v"), F.least("nid", "first").alias("u")).distinct()
            pairs = staged(agreeing(staged(pairs, "near-met"), nodes, threshold), "near-pairs")
            roots = _merged(roots, staged(verified_pairs(pairs, texts, idf, threshold), "near-links"))
            turn += 1
        return keys, roots

    keys, roots = turns(keys, roots, LEADERS)
    gathered: list[DataFrame] = []
    whole = None
    for level in range(LEVELS + 1):
        rows = keys.join(roots, "nid").join(texts.select("nid", F.octet_length("t").alias("bytes")), "nid")
        spans = rows.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"),
                                        F.sum("bytes").alias("bytes")).filter("a < b")
        large = (F.col("n") > group_nodes) | (F.col("bytes") > group_bytes)
        sized = staged(keys.join(staged(spans.select("key", large.alias("large")), "near-spans"), "key"), "near-sized")
        gathered.append(sized.filter("NOT large").select("nid", "key"))
        keys = sized.filter("large").select("nid", "band", "key")
        if keys.isEmpty():
            break
        if whole is None:
            whole = keys.select("nid", "key")
        keys, roots = turns(keys, roots, MORE_LEADERS)
        if level == LEVELS or keys.isEmpty():
            break
        keys = smaller_keys(keys, nodes, level)
    rows = gathered[0]
    for more in gathered[1:]:
        rows = rows.unionAll(more)
    links = gathered_links(rows.join(roots, "nid"), nodes, texts, idf, threshold)
    roots = _merged(roots, staged(links, "near-links"))
    if whole is None:
        return roots
    rows = block_pairs(whole.join(roots, "nid"), texts, group_nodes, group_bytes)
    if rows.isEmpty():
        return roots
    links = gathered_links(rows.join(roots, "nid"), nodes, texts, idf, threshold)
    return _merged(roots, staged(links, "near-links"))


def block_pairs(rows: DataFrame, texts: DataFrame, group_nodes: int, group_bytes: int) -> DataFrame:
    """(nid, key) of groups in which every two nodes of a bucket of (nid, key, root) meet, if it
    spans components: its nodes fall into blocks of about half a group, and a group is two blocks."""
    spans = rows.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("key")
    open_ = rows.select("nid", "key").join(staged(spans, "near-spans"), "key").join(
        texts.select("nid", F.octet_length("t").alias("bytes")), "nid")
    open_ = staged(open_, "near-whole")
    half = F.greatest(F.count("*") * 2 / group_nodes, F.sum("bytes") * 2 / group_bytes)
    blocks = open_.groupBy("key").agg(F.least(F.count("*"), F.greatest(F.lit(2), F.ceil(half))).alias("blocks"))
    placed = open_.join(staged(blocks, "near-blocks"), "key").withColumn("mine", F.pmod(F.xxhash64("nid"), F.col("blocks")))
    other = unfold(placed, F.col("blocks"), "other").filter("other != mine")
    group = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))
    return staged(other.select("nid", group.alias("key")), "near-block-pairs")


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity of two weighted sets, each sorted hashes and weights."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64)
    high = a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - low
    return float(low / high) if high > 0 else 0.0


def _sets(column: pa.Array, table: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted hashes and weights of each text's shingles."""
    out = []
    for a, b, h, r, n in _parts(column):
        cuts = np.searchsorted(r, np.arange(b - a + 1))
        w = table[_cell(h)] * n.astype(np.float32)
        out.extend((h[x:y], w[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True))
    return out


def bucket_links(sets: list[tuple[np.ndarray, np.ndarray]], sigs: np.ndarray, roots: np.ndarray, threshold: float,
                 agreement: int) -> list[tuple[int, int]]:
    """Links between components among the nodes of one bucket, a spanning
    forest of them: rows i and j for every two components that a link joins.

    A row's similarity to all others comes from the postings of its shingles."""
    m = len(sets)
    name, comp = np.unique(roots, return_inverse=True)
    sizes = np.array([len(h) for h, _ in sets])
    owners = np.repeat(np.arange(m), sizes)
    hashes, weights = np.concatenate([h for h, _ in sets]), np.concatenate([w for _, w in sets])
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order][:1]))
    stops = np.append(first[1:], len(order))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.repeat(np.arange(len(first)), stops - first)
    totals = np.bincount(owners, weights, minlength=m)
    ends = np.cumsum(sizes)
    out = []
    for i in range(m - 1):
        open_ = np.flatnonzero(comp[i + 1:] != comp[i]) + i + 1
        if not len(open_):
            continue
        near = open_[(sigs[open_] == sigs[i]).sum(axis=1) >= agreement]
        if not len(near):
            continue
        mine = slice(ends[i] - sizes[i], ends[i])
        a, b = first[place[mine]], stops[place[mine]]
        n = b - a
        at = order[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())]
        low = np.bincount(owners[at], np.minimum(weights[at], np.repeat(weights[mine], n)), minlength=m)[near]
        for j in near[low >= threshold * (totals[i] + totals[near] - low)]:
            if comp[j] != comp[i]:
                out.append((i, int(j)))
                comp[comp == comp[j]] = comp[i]
    return out


def gathered_links(rows: DataFrame, nodes: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Links (v, u) between components in the buckets of (nid, key, root)."""
    agreement = least_agreement(threshold)

    def link(bucket: pa.Table) -> pa.Table:
        bucket = bucket.combine_chunks()
        sigs = bucket.column("sig").combine_chunks()
        sigs = sigs.flatten().to_numpy(zero_copy_only=False).reshape(bucket.num_rows, SAMPLES)
        nid, roots = bucket.column("nid").to_numpy(), bucket.column("root").to_numpy()
        pairs = bucket_links(_sets(bucket.column("t"), idf.value), sigs, roots, threshold, agreement)
        ends = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        both = np.sort(nid[ends], axis=1)
        return pa.table({"v": both[:, 1], "u": both[:, 0]})

    spans = rows.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("key")
    wanted = staged(rows.join(spans, "key"), "near-gathered")
    own = staged(wanted.select("nid").distinct(), "near-own")
    known = texts.join(broadcast_if_small(own), "nid").join(nodes.select("nid", "sig"), "nid")
    return wanted.join(known, "nid").groupBy("key").applyInArrow(link, "v long, u long").distinct()


def verified_pairs(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs whose texts (node, t) reach ``threshold``."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                both = zip(_sets(batch.column(2), table), _sets(batch.column(3), table), strict=True)
                good = np.array([weighted_jaccard(x, y) >= threshold for x, y in both], dtype=bool)
                yield batch.select([0, 1]).filter(pa.array(good))

    # Pairs are two numbers; counted and small, they are sent to the texts,
    # else both sides are shuffled.  Only texts that a pair needs move on.
    sent = broadcast_if_small(pairs)
    left = texts.select(F.col("nid").alias("v"), F.col("t").alias("tv")).join(sent, "v")
    right = texts.select(F.col("nid").alias("u"), F.col("t").alias("tu")).join(sent, "u")
    return left.join(right, ["v", "u"]).select("v", "u", "tv", "tu").mapInArrow(verify, "v long, u long")


def _placed(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The signed documents (id, node, ...), and one row per node: its class
    (id, size, and the id and node of the document to keep)."""
    spark = docs.sparkSession
    with_code(spark)
    n_docs, df = document_frequencies(docs, text_col)
    idf = spark.sparkContext.broadcast(idf_weights(n_docs, df))  # 2**CELL_BITS numbers
    sigs = staged(signed(docs, id_col, text_col, idf), "near-signatures")
    nodes = staged(sigs.groupBy("node").agg(F.first("sig").alias("sig"), F.min("id").alias("id"), F.count("*").alias("n"))
                   .withColumn("nid", F.monotonically_increasing_id()), "near-nodes")
    keys = bucket_keys(nodes)
    wanted = staged(keys.select("nid").distinct(), "near-wanted")
    pick = staged(nodes.join(wanted, "nid").select("nid", F.col("node").alias("of"), F.col("id").alias("least")),
                  "near-pick")
    own = docs.select(F.col(id_col).alias("id"), node_of(text_col).alias("node"), text_or_empty(text_col).alias("t"))
    # Merge join at every size; of rows with equal id and text one is read.
    rows = own.join(pick.hint("merge"), (F.col("node") == F.col("of")) & F.col("id").eqNullSafe(F.col("least")))
    texts = staged(rows.select("nid", "t").dropDuplicates(["nid"]), "near-texts")
    roots = node_components(keys, nodes, texts, idf, threshold)
    rooted = staged(nodes.select("nid", "node", "id", "n").join(roots, "nid", "left").withColumn(
        "root", F.coalesce("root", "nid")), "near-rooted")
    keep = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "node")).alias("kept")
    classes = staged(rooted.groupBy("root").agg(keep, F.sum("n").alias("class_size")), "near-classes")
    return sigs, staged(rooted.select("node", "root").join(classes, "root"), "near-node-classes")


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: its id, class id (the least document id of the
    class, null if none has an id) and class size."""
    sigs, classes = _placed(docs, id_col, text_col, threshold)
    return sigs.select("id", "node").join(classes, "node").select(
        F.col("id").alias(id_col), F.col("kept.id").alias("class_id"), "class_size")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class: the least id, then text digest; all columns."""
    _, classes = _placed(docs, id_col, text_col, threshold)
    kept = classes.filter("node = kept.node").select(
        F.col("node").alias(OWN + "of"), F.col("kept.id").alias(OWN + "id"))
    own = docs.withColumn(OWN + "node", node_of(text_col))
    mine = own.join(kept.hint("merge"), (F.col(OWN + "node") == F.col(OWN + "of")) & F.col(id_col).eqNullSafe(F.col(OWN + "id")))
    order = [F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])]
    copy = F.row_number().over(Window.partitionBy(OWN + "of", OWN + "id").orderBy(*order))
    return mine.withColumn(OWN + "copy", copy).filter(F.col(OWN + "copy") == 1).select(
        *[F.col(f"`{c}`") for c in docs.columns])
