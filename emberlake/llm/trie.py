"""Conversation prefix trie from padded turn-id matrices.

Conversations that begin alike share their first turns.  A turn is the digest
of its role and text, a conversation the sequence of its turns, and each distinct
prefix of a conversation is a node.  The distinct sequences are range-partitioned
and sorted; a task cuts its range into shards of at most ``SHARD_CELLS`` cells
of a matrix of turn ids, one row per sequence, padded with -1.  In a shard a
numpy lexsort orders the rows, the changes from row to row, OR-accumulated along
the columns, mark the cells where a node starts, and ``reduceat`` over those
starts gives every node of a depth its members, smallest id, leaves and savings.

Only the nodes on the paths of a shard's first and last row can have members
elsewhere.  These boundary nodes are recombined by the digest of their prefix:
their counts are added up; then each one's own saving and leaf, which need
the whole counts, are credited to one shard and added to the nodes above it
there.

Scale: equal sequences are one row, whatever their number, and a sequence's
ids travel in text blocks of ``ID_BLOCK`` ids, which a task reads in order, one
at a time, to hash them.  Shards are bounded by cells, so long conversations make
shards of few rows.  A conversation's sequence is one row of 32 characters a turn.  The
parents of a shard's nodes are found by (shard, path, depth), of which one has at most a
shard's rows.

Cases: a null conversation id is no conversation, its rows join none; a null
role or text is empty; null turn numbers come first; turns of one number are
ordered by the digest of role and text and repeated rows are turns of their
own; a rebuilt conversation without turns ends at the root; an empty table has
no node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import crc32_sql, staged, text_or_empty, with_code

DIGEST = 32  # characters of a turn's digest
ID_BLOCK = 4096
SHARD_CELLS = 1 << 22
EVERY, HEADS = 5, 9
FIRST, LAST = 1, 2  # bits of ``path``: the node lies on the path of the shard's first, last row

NODE_FIELDS = [("shard", pa.int64()), ("depth", pa.int64()), ("path", pa.int32()), ("key", pa.string()),
               ("parent_key", pa.string()), ("parent_path", pa.int32()), ("parent_conv_id", pa.int64()),
               ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
               ("saved", pa.int64()), ("n_bytes", pa.int64()), ("ends", pa.string())]
NODE_SCHEMA = ", ".join(f"{n} {'string' if t == pa.string() else 'int' if t == pa.int32() else 'long'}" for n, t in NODE_FIELDS)


def conversation_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                       role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turns): the turns of each conversation in order, as digest and
    bytes of the text."""
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    one = F.struct(F.col(turn_col).cast("long").alias("turn"), digest.alias("digest"),
                   F.octet_length(text).cast("long").alias("n_bytes"))
    return (turns.filter(F.col(conv_col).isNotNull()).groupBy(F.col(conv_col).cast("long").alias("conv"))
            .agg(F.sort_array(F.collect_list(one)).alias("turns")))


def rebuilt(convs: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the first
    conversation of its block of ``EVERY`` ids."""
    of = F.col("conv") - F.col("conv") % EVERY
    heads = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(HEADS)).cast("int")
    own = convs.select("conv", "turns", of.alias("of"), heads.alias("h"))
    base = convs.filter(F.col("conv") % EVERY == 0).select(F.col("conv").alias("of"), F.col("turns").alias("head"))
    joined = own.join(base, "of", "left")
    none = F.slice("turns", 1, 0)
    whole = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                     F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1))))
    return joined.select("conv", whole.alias("turns"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sequences from their sorted blocks of ids: members, smallest, and the
    digest of all ids, comma-joined."""
    schema = pa.schema([("path", pa.string()), ("sizes", pa.list_(pa.int64())), ("n", pa.int64()), ("least", pa.int64()),
                        ("ends", pa.string())])
    current, hasher, n, least, carried = None, None, 0, 0, None

    def done() -> tuple:
        return (*carried, n, least, hasher.hexdigest())

    for batch in batches:
        out = []
        path, sizes = batch.column("path"), batch.column("sizes")
        for i, (seq, ids, m, low) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("seq", "ids", "n", "least")], strict=True)):
            if seq != current:
                if current is not None:
                    out.append(done())
                current, hasher, n, least, carried = seq, hashlib.sha256(), 0, low, (path[i].as_py(), sizes[i].as_py())
            else:
                hasher.update(b",")
            hasher.update(ids.encode())
            n += m
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types, strict=True)], schema=schema)
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(done(), schema.types, strict=True)], schema=schema)


def sequences(convs: DataFrame) -> DataFrame:
    """One row per distinct sequence of a table (conv, turns): its path (the
    turns' digests, joined), the turns' bytes, members, smallest id and the
    digest of the members' ids."""
    path = F.array_join(F.transform("turns", lambda t: t.digest), "")
    rows = convs.select("conv", path.alias("path"), F.transform("turns", lambda t: t.n_bytes).alias("sizes"))
    rows = rows.withColumn("seq", F.sha2(F.col("path").cast("binary"), 256)).withColumn(
        "block", F.floor(F.col("conv") / ID_BLOCK).cast("long"))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    blocks = rows.groupBy("seq", "block").agg(
        F.first("path").alias("path"), F.first("sizes").alias("sizes"), F.count("*").alias("n"),
        F.min("conv").alias("least"), ids.alias("ids"))
    ordered = blocks.repartition("seq").sortWithinPartitions("seq", "block")
    return ordered.mapInArrow(_hashed, "path string, sizes array<long>, n long, least long, ends string")


def shard_nodes(paths: list[str], sizes: list[list[int]], n: np.ndarray, least: np.ndarray, ends: list[str],
                shard: int) -> pa.RecordBatch:
    """The nodes of one shard of distinct sequences.

    Nodes off the boundary are final.  On the boundary ``n_children``,
    ``n_leaves`` and ``saved`` count what lies off the boundary only."""
    lengths = np.array([len(p) // DIGEST for p in paths], dtype=np.int64)
    rows, width = len(paths), int(lengths.max())
    held = np.arange(width) < lengths[:, None]
    flat = np.frombuffer("".join(paths).encode(), dtype=f"S{DIGEST}") if width else np.zeros(0, "S1")
    matrix = np.full((rows, width), -1, dtype=np.int64)
    matrix[held] = np.unique(flat, return_inverse=True)[1]
    n_bytes = np.zeros((rows, width), dtype=np.int64)
    n_bytes[held] = np.array([b for s in sizes for b in s], dtype=np.int64)
    order = np.lexsort(matrix.T[::-1]) if width else np.arange(rows)
    matrix, n_bytes, held, lengths, n, least = (a[order] for a in (matrix, n_bytes, held, lengths, n, least))
    starts = np.ones((rows, width), dtype=bool)
    starts[1:] = np.logical_or.accumulate(matrix[1:] != matrix[:-1], axis=1)
    starts &= held
    number = np.cumsum(starts, axis=0) - 1  # of a row's node among its depth's nodes
    at = np.arange(width)
    # Rows in a node, and whether its path is that of the first or last row.
    first_node = np.where(held[0], 0, -1)
    last_node = np.where(held[-1], number[-1], -1)
    on_path = (FIRST * (number == first_node) + LAST * (number == last_node)) * held
    deep = np.maximum(lengths - 1, 0)
    extended = np.zeros(rows, dtype=bool)  # by the next row
    can = np.flatnonzero((lengths[:-1] > 0) & (lengths[1:] > lengths[:-1]))
    extended[can] = ~starts[can + 1, deep[can]]
    end_path = on_path[np.arange(rows), deep] if width else np.zeros(rows, dtype=np.int64)
    leaf = ((lengths > 0) & ~extended & (end_path == 0)).astype(np.int64)
    big = np.iinfo(np.int64).max
    members = np.zeros((rows, width), dtype=np.int64)  # at starts
    for d in at:
        s = np.flatnonzero(starts[:, d])
        members[s, d] = np.add.reduceat(n * held[:, d], s)
    own = np.where(starts & (on_path == 0), (members - 1) * n_bytes, 0)
    below = np.cumsum(own[:, ::-1], axis=1)[:, ::-1]
    ended = np.array(ends, dtype=object)[order]

    def keys_of(row: int) -> list[str]:
        h = hashlib.md5()
        out = [h.copy().hexdigest()]
        path = paths[order[row]]
        for d in range(int(lengths[row])):
            h.update(path[d * DIGEST:(d + 1) * DIGEST].encode())
            out.append(h.copy().hexdigest())
        return out

    first_keys, last_keys = keys_of(0), keys_of(rows - 1)
    turnless = np.flatnonzero(lengths == 0)
    child_paths = on_path[starts[:, 0], 0] if width else np.zeros(0)
    columns: dict[str, list] = {name: [] for name, _ in NODE_FIELDS}

    def add(depth: int, **given) -> None:
        m = len(given["conv_id"])
        for name, _ in NODE_FIELDS:
            columns[name].append(given[name] if name in given else np.full(m, shard if name == "shard" else depth))

    one = lambda x: np.array([x])
    add(0, path=one(FIRST | LAST), key=[first_keys[0]], parent_key=[None], parent_path=one(0), parent_conv_id=[None],
        conv_id=one(least.min()), n_convs=one(n.sum()), n_children=one(int((child_paths == 0).sum())),
        n_leaves=one(leaf.sum()), saved=one(below[:, 0].sum() if width else 0), n_bytes=one(0),
        ends=[ended[turnless[0]] if len(turnless) else None])
    parent_least, parent_number = one(least.min()), np.zeros(rows, dtype=np.int64)
    for d in at:
        s = np.flatnonzero(starts[:, d])
        smallest = np.minimum.reduceat(np.where(held[:, d], least, big), s)
        paths_here = on_path[s, d]
        parents = parent_number[s]
        parent_paths = on_path[s, d - 1] if d else np.full(len(s), FIRST | LAST)
        if d + 1 < width:
            children = starts[:, d + 1] & (on_path[:, d + 1] == 0)
            n_children = np.bincount(number[children, d], minlength=len(s))
        else:
            n_children = np.zeros(len(s), dtype=np.int64)
        keys, up = np.full(len(s), None, dtype=object), np.full(len(s), None, dtype=object)
        for node, names in ((first_node[d], first_keys), (last_node[d], last_keys)):
            if node >= 0:
                keys[node], up[node] = names[d + 1], names[d]
        ends_here = np.full(len(s), None, dtype=object)
        stop = np.flatnonzero(lengths == d + 1)
        ends_here[number[stop, d]] = ended[stop]
        add(int(d) + 1, path=paths_here, key=keys, parent_key=up, parent_path=parent_paths,
            parent_conv_id=pa.array(parent_least[parents], mask=parent_paths > 0), conv_id=smallest,
            n_convs=members[s, d], n_children=n_children, n_leaves=np.add.reduceat(leaf * held[:, d], s),
            saved=np.add.reduceat(below[:, d], s), n_bytes=n_bytes[s, d], ends=ends_here)
        parent_least, parent_number = smallest, number[:, d]
    arrays = [pa.concat_arrays([x if isinstance(x, pa.Array) else pa.array(x, t, from_pandas=True) for x in columns[name]])
              for name, t in NODE_FIELDS]
    return pa.RecordBatch.from_arrays([a.cast(t) for a, (_, t) in zip(arrays, NODE_FIELDS, strict=True)],
                                      schema=pa.schema(NODE_FIELDS))


def _sharded(shard_cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts a sorted range of sequences into shards and emits their nodes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 32, 0
        kept: list[tuple] = []
        widest = 0

        def flush() -> pa.RecordBatch:
            paths, sizes, n, least, ends = zip(*kept)
            return shard_nodes(list(paths), list(sizes), np.array(n, dtype=np.int64), np.array(least, dtype=np.int64),
                               list(ends), base + count)

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                wide = max(widest, len(row[0]) // DIGEST + 1)
                if kept and wide * (len(kept) + 1) > shard_cells:
                    yield flush()
                    count, kept, wide = count + 1, [], len(row[0]) // DIGEST + 1
                kept.append(row)
                widest = wide
        if kept:
            yield flush()
    return run


def combined(nodes: DataFrame) -> DataFrame:
    """Whole nodes from the stored nodes of all shards."""
    none = hashlib.sha256(b"").hexdigest()
    edge = nodes.filter("path > 0")
    met = staged(edge.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner"),
        F.max("n_bytes").alias("n_bytes"), F.max("ends").alias("ends"), F.min("shard").alias("home"),
        F.max("parent_key").alias("parent_key")), "trie-met")
    children = met.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_key").alias("key")).agg(
        F.count("*").alias("outer"))
    whole = met.join(children, ["depth", "key"], "left").withColumn("n_children", F.col("inner") + F.coalesce("outer", F.lit(0)))
    whole = staged(whole.select("depth", "key", "home", F.col("conv_id").alias("least"), F.col("n_convs").alias("members"),
                                "n_children", "ends", "parent_key",
                                ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("own_saved"),
                                (F.col("n_children") == 0).cast("long").alias("own_leaf")), "trie-whole")
    # What a boundary node adds itself is credited to its first shard, and there
    # to the nodes above it on the path of the first row or of the last.
    seen = edge.select("shard", "depth", "path", "key", "n_leaves", "saved").join(
        whole.select("depth", "key", "home", "own_saved", "own_leaf", "least"), ["depth", "key"])
    deeper = Window.partitionBy("shard").orderBy(F.desc("depth"))
    both, first = F.col("path") == FIRST | LAST, F.col("path").bitwiseAND(FIRST) > 0

    def credit(own: str) -> Column:
        here = F.when(F.col("home") == F.col("shard"), F.col(own)).otherwise(0)
        on_first = F.sum(F.when(first, here).otherwise(0)).over(deeper)
        on_last = F.sum(F.when(first, 0).otherwise(here)).over(deeper)
        return F.when(both, on_first + on_last).when(first, on_first).otherwise(on_last)

    seen = staged(seen.select("shard", "depth", "path", "key", "least", (F.col("saved") + credit("own_saved")).alias("saved"),
                              (F.col("n_leaves") + credit("own_leaf")).alias("n_leaves")), "trie-seen")
    sums = seen.groupBy("depth", "key").agg(F.sum("saved").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    above = whole.select((F.col("depth") + 1).alias("depth"), F.col("key").alias("parent_key"), F.col("least").alias("parent_conv_id"))
    outer = whole.join(sums, ["depth", "key"]).join(above, ["depth", "parent_key"], "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("members").alias("n_convs"), "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(none)).alias("ends_sha256"))
    known = seen.select("shard", (F.col("depth") + 1).alias("depth"), F.col("path").alias("parent_path"),
                        F.col("least").alias("found"))
    inner = nodes.filter("path = 0").join(known, ["shard", "depth", "parent_path"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "found").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(none)).alias("ends_sha256"))
    return outer.unionByName(inner)


def prefix_trie(convs: DataFrame, shard_cells: int = SHARD_CELLS) -> DataFrame:
    """One row per node of the trie of a table (conv, turns), see
    ``conversation_turns``."""
    with_code(convs.sparkSession)
    distinct = staged(sequences(convs), "trie-sequences")
    ranged = distinct.repartitionByRange("path").sortWithinPartitions("path").select("path", "sizes", "n", "least", "ends")
    nodes = staged(ranged.mapInArrow(_sharded(shard_cells), NODE_SCHEMA), "trie-nodes")
    return combined(nodes)


def trie_report(turns: DataFrame, shard_cells: int = SHARD_CELLS) -> DataFrame:
    """The trie of the rebuilt conversations."""
    convs = staged(conversation_turns(turns), "trie-conversations")
    return prefix_trie(rebuilt(convs), shard_cells)


ORACLE = f"""
WITH t AS (
  SELECT conv_id, coalesce(text, '') AS text,
    md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), heads AS (
  SELECT conv_id AS conv, conv_id - conv_id % {EVERY} AS of_conv, {crc32_sql("CAST(conv_id AS VARCHAR)")} % {HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT conv, 0 AS part, i, digest, text FROM heads JOIN t ON t.conv_id = of_conv WHERE i <= h
  UNION ALL
  SELECT conv, 1, i, digest, text FROM heads JOIN t ON t.conv_id = conv WHERE i > h
), o AS (
  SELECT conv, CAST(strlen(text) AS BIGINT) AS n_bytes, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv ORDER BY part, i)
), m AS (
  SELECT conv, depth, path, n_bytes, depth = max(depth) OVER (PARTITION BY conv) AS is_end FROM o
  UNION ALL
  SELECT conv, 0, '', 0, conv NOT IN (SELECT conv FROM o) FROM heads
), n AS (
  SELECT path, depth, min(conv) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n_bytes) AS own,
    sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (is_end), '')) AS ends_sha256
  FROM m GROUP BY path, depth
), c AS (
  SELECT left(path, length(path) - {DIGEST}) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1
), f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (path)
), up AS (
  SELECT left(path, CAST({DIGEST} * unnest(range(depth + 1)) AS INT)) AS path, own, n_children = 0 AS leaf FROM f
), sums AS (
  SELECT path, CAST(sum(own) AS BIGINT) AS saved_tokens, count(*) FILTER (leaf) AS n_leaves FROM up GROUP BY path
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM f JOIN sums USING (path) LEFT JOIN n AS p ON f.depth > 0 AND p.path = left(f.path, length(f.path) - {DIGEST})
"""
