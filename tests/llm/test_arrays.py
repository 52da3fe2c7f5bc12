"""Near-duplicates, repeats, packing, sharding and toxicity against plain versions."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlake.llm import neardup, packing, repeats, sharding, suffixes, toxicity
from emberlake.llm.common import staged
from emberlake.llm.components import components
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.helpers import WORDS, awkward, documents, plain_shingles, prose


def plain_classes(rows):
    """doc rows -> class id of each row, from exact weighted similarities."""
    n_docs = sum(bool(plain_shingles(t)) for _, t in rows)
    raw = [t or "" for _, t in rows]
    import pyarrow as pa
    sets = []
    for a, b, h, r, n in neardup._parts(pa.array(raw)):
        cut = np.searchsorted(r, np.arange(b - a + 1))
        sets += [(h[x:y], n[x:y]) for x, y in zip(cut[:-1], cut[1:])]
    df = np.zeros(1 << neardup.CELL_BITS, dtype=np.int64)
    for h, _ in sets:
        np.add.at(df, neardup._cell(h), 1)
    w = neardup.idf_weights(n_docs, df)
    sets = [(h, w[neardup._cell(h)] * n.astype(np.float32)) for h, n in sets]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if raw[i] == raw[j] or neardup.weighted_jaccard(sets[i], sets[j]) >= neardup.THRESHOLD:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(rows))]


def near_copies(rng, n):
    rows = []
    for g in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(40, 200))]
        for c in range(rng.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    return rows


def test_classes_equal_brute_force(spark):
    rows = near_copies(random.Random(1), 60)
    rows += [(1000, ""), (1001, None), (None, rows[0][1]), (1002, "two words"), (1003, "Two, words!"), (1004, rows[3][1]),
             (1004, rows[3][1]), (None, "nobody else has this text at all"), (1005, "?!"), (1006, "?")]
    got = sorted(map(repr, ((r.doc_id, r.class_id) for r in neardup.duplicate_classes(documents(spark, rows)).collect())))
    assert got == sorted(map(repr, zip([r[0] for r in rows], plain_classes(rows), strict=True)))
    kept = neardup.drop_duplicates(documents(spark, rows)).collect()
    classes = {c for c in plain_classes(rows)}
    assert {r.doc_id for r in kept} == classes and len(kept) == len(classes)


def test_hot_group_of_near_copies(spark):
    """A third of all rows are copies or near copies of one text; a passage is in all others."""
    rng = random.Random(2)
    base, passage = [rng.choice(WORDS) for _ in range(150)], prose(rng, 60)
    rows = [(i, " ".join(base if i % 2 else [*base[:i], f"x{i}", *base[i + 1:]])) for i in range(60)]
    rows += [(100 + i, prose(rng, 80) + "\n" + passage + "\n" + prose(rng, 80)) for i in range(120)]
    out = {r.doc_id: r.class_id for r in neardup.duplicate_classes(documents(spark, rows)).collect()}
    assert {out[i] for i in range(60)} == {0}
    assert all(out[100 + i] == 100 + i for i in range(120))


@pytest.mark.parametrize("group_nodes, group_bytes", [(512, 1 << 24), (12, 1 << 24), (512, 3000)])
def test_links_are_searched_to_the_end(spark, group_nodes, group_bytes):
    """Couples in one bucket, so that a leader finds one link, beside 300 links found at once."""
    rng = random.Random(7)

    def couple(i, at):
        words = [rng.choice(WORDS) for _ in range(60)]
        return [(at, i, " ".join(words)), (at + 1, i, " ".join([*words[:30], "other", *words[31:]] if i else words[1:]))]

    rows = [r for i in range(40) for r in couple(0, 2 * i)] + [r for i in range(300) for r in couple(100 + i, 1000 + 10 * i)]
    rng.shuffle(rows)
    own = np.random.default_rng(3)
    sigs = {n // 2: own.integers(0, 9, neardup.SAMPLES).tolist() for n, *_ in rows}
    nodes = spark.createDataFrame([(n, sigs[n // 2]) for n, *_ in rows], "nid long, sig array<int>")
    keys = spark.createDataFrame([(n, 0, k) for n, k, _ in rows], "nid long, band int, key long")
    texts = spark.createDataFrame([(n, t) for n, _, t in rows], "nid long, t string")
    n_docs, df = neardup.document_frequencies(texts, "t")
    idf = spark.sparkContext.broadcast(neardup.idf_weights(n_docs, df))
    roots = {r.nid: r.root for r in neardup.node_components(
        staged(keys, "k"), staged(nodes, "n"), staged(texts, "t"), idf, 0.8, group_nodes, group_bytes).collect()}
    assert all(roots[2 * i] == roots[2 * i + 1] == 2 * i for i in range(40))
    assert all(roots[1001 + 10 * i] == 1000 + 10 * i for i in range(300))


def test_a_larger_bucket_loses_no_link_to_its_smaller_ones(spark):
    """Couples whose signatures agree, but not in the samples that part their bucket."""
    rng, own = random.Random(8), np.random.default_rng(4)
    rows, sigs = [], []
    for i in range(40):
        words = [rng.choice(WORDS) for _ in range(60)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[1:]))]
        sig = own.integers(0, 1 << 30, neardup.SAMPLES)
        sigs += [(2 * i, sig.tolist()), (2 * i + 1, (sig ^ np.isin(np.arange(neardup.SAMPLES), [3, 6])).tolist())]
    keys = staged(spark.createDataFrame([(n, 0, 5) for n, _ in rows], "nid long, band int, key long"), "k")
    nodes = staged(spark.createDataFrame(sigs, "nid long, sig array<int>"), "n")
    texts = staged(spark.createDataFrame(rows, "nid long, t string"), "t")
    idf = spark.sparkContext.broadcast(neardup.idf_weights(*neardup.document_frequencies(texts, "t")))
    roots = {r.nid: r.root for r in neardup.node_components(keys, nodes, texts, idf, 0.8, group_nodes=8).collect()}
    assert all(roots[2 * i] == roots[2 * i + 1] == 2 * i for i in range(40))


def test_larger_buckets_lose_few_links(spark, monkeypatch):
    """A dense group at the threshold, with buckets far above the size that a task takes."""
    monkeypatch.setattr(neardup, "GROUP_NODES", 16)
    rng = random.Random(15)
    base = [rng.choice(WORDS) for _ in range(150)]
    rows = []
    for i in range(300):
        copy = list(base)
        for at in rng.sample(range(150), rng.choice([1, 2, 4, 6, 9])):
            copy[at] = f"edit{i}x{at}"
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: r.class_id for r in neardup.duplicate_classes(documents(spark, rows)).collect()}
    want = dict(zip([r[0] for r in rows], plain_classes(rows), strict=True))
    linked = [i for i, c in want.items() if sum(x == c for x in want.values()) > 1]
    assert all(want[i] == want[c] for i, c in got.items())  # nothing joined that is apart
    assert sum(got[i] == want[i] for i in linked) >= 0.9 * len(linked)


def test_bucket_links_equal_brute_force():
    rng = random.Random(16)
    rows = near_copies(rng, 25)
    import pyarrow as pa
    table = np.ones(1 << neardup.CELL_BITS, dtype=np.float32)
    sets = neardup._sets(pa.array([t for _, t in rows]), table)
    pairs = neardup.bucket_links(sets, np.zeros((len(rows), neardup.SAMPLES)), np.arange(len(rows)), 0.8, 1)
    parent = list(range(len(rows)))
    for i, j in pairs:
        parent = [parent[i] if p == parent[j] else p for p in parent]
    for i in range(len(rows)):
        for j in range(i):
            if neardup.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                assert parent[i] == parent[j]
    assert len(pairs) == len(rows) - len(set(parent))


def test_signature_filter_misses_less_than_the_bands():
    rng = np.random.default_rng(4)
    agree = rng.binomial(neardup.SAMPLES, neardup.THRESHOLD, 2_000_000)
    assert (agree < neardup.least_agreement(neardup.THRESHOLD)).mean() < (1 - neardup.THRESHOLD ** neardup.ROWS) ** neardup.BANDS


def test_weighted_sampling_estimates_similarity():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 48, 400, dtype=np.uint64)
    a, b = np.sort(h[:300]), np.sort(h[100:])
    wa, wb = np.where(a % np.uint64(3) == 0, 3, 1).astype(np.float32), np.where(b % np.uint64(3) == 0, 3, 1).astype(np.float32)
    wb[b % np.uint64(5) == 0] *= 2
    runs = [(neardup.signatures(a * np.uint64(s), np.array([0]), wa) == neardup.signatures(b * np.uint64(s), np.array([0]), wb)).mean()
            for s in range(1, 120, 2)]
    assert abs(np.mean(runs) - neardup.weighted_jaccard((a, wa), (b, wb))) < 0.03


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_components(spark, one_task):
    edges = [(i + 1, i) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    out = {r.node: r.root for r in components(spark.createDataFrame(edges, "v long, u long"), one_task_edges=one_task).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}
    assert out == want
    assert components(spark.createDataFrame([], "v long, u long"), one_task_edges=one_task).collect() == []


def plain_repeats(rows):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for q in range(len(b) - 49):
            first[b[q:q + 50]] = min(first.get(b[q:q + 50], float("inf")), float("inf") if d is None else d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for q in range(len(b) - 49):
            if first[b[q:q + 50]] < (float("inf") if d is None else d):
                gone[q:q + 50] = True
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((d, len(b), int(gone.sum()), int(edge.sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [0, 2, 8])
def test_repeats_equal_brute_force(spark, hot):
    rng = random.Random(hot)
    passages = [prose(rng, rng.choice([4, 8, 40])) for _ in range(6)] + ["ab" * 60, "x" * 130, "é" * 40]
    rows = []
    for i in range(60):
        bits = [rng.choice(passages)[rng.randrange(3):] if rng.random() < 0.5 else prose(rng, 8) for _ in range(rng.randint(0, 5))]
        rows.append((rng.choice([i, i, i // 2, None]), "".join(bits)))
    rows += [(500, None), (501, ""), (502, passages[0][:49]), (503, passages[0][:50]), (-1, passages[1]), (504, rows[0][1])]
    rng.shuffle(rows)
    docs = documents(spark, rows).repartition(5)
    got = repeats.remove_repeats(docs, hot_regions=hot, with_text=True).collect()
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, plain_repeats(rows)))
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_suffix_sort_is_a_sort():
    rng = np.random.default_rng(5)
    data = rng.integers(97, 99, size=(80, suffixes.REGION)).astype(np.uint8)
    data[40:] = data[:40]
    record = np.arange(80)
    s = suffixes.Suffixes(data, record, np.zeros(80, dtype=np.int64))
    order, classes = s.classes(np.zeros(80, dtype=np.uint64))
    texts = [data[i, :suffixes.LENGTH].tobytes() for i in order]
    assert texts == sorted(texts) and classes[-1] == len(set(texts)) - 1


def test_suffix_sort_reads_a_word_only_of_equal_suffixes(monkeypatch):
    read, word = [], suffixes.Suffixes.word
    monkeypatch.setattr(suffixes.Suffixes, "word", lambda self, s, w: read.append(len(s)) or word(self, s, w))
    data = np.random.default_rng(6).integers(0, 256, size=(900, suffixes.REGION)).astype(np.uint8)
    data[1] = data[0]
    data[2, :] = data[0, :]
    data[2, suffixes.LENGTH - 1] ^= 1
    data[2, suffixes.LENGTH:] ^= 1  # bytes behind a window do not count
    order, classes = suffixes.Suffixes(data, np.arange(900), np.zeros(900, dtype=np.int64)).classes(np.zeros(900, dtype=np.uint64))
    texts = [data[i, :suffixes.LENGTH].tobytes() for i in order]
    assert texts == sorted(texts) and classes[-1] == 898
    assert read == [900] + [3] * 6


@pytest.mark.parametrize("n_sources, n_pieces, common", [(6, 300, 256), (300, 700, 256), (300, 700, 3), (1, 20, 256)])
def test_packing_takes_the_tightest_compatible_bin(monkeypatch, n_sources, n_pieces, common):
    monkeypatch.setattr(packing, "COMMON_SOURCES", common)
    rng = random.Random(6)
    source = lambda: min(rng.randrange(n_sources), rng.randrange(n_sources))
    pieces = pd.DataFrame([(i, 0, rng.randint(0, 60), source() * 10**15, rng.randrange(40)) for i in range(n_pieces)],
                          columns=["rid", "piece", "length", "source", "cluster"])
    got = packing.pack_group(pieces, 100)
    bins = []
    for p in pieces.sort_values(["length", "rid"], ascending=[False, True]).itertuples():
        fits = [(100 - b["n"] - p.length, i) for i, b in enumerate(bins)
                if b["n"] + p.length <= 100 and p.source not in b["s"] and p.cluster not in b["c"]]
        row = got[got.rid == p.rid].iloc[0]
        if fits:
            left = 100 - bins[row.bin]["n"] - p.length
            assert (left, row.bin) in fits and left == min(fits)[0]
        else:
            assert row.bin == len(bins)
            bins.append({"n": 0, "s": set(), "c": set()})
        b = bins[row.bin]
        assert row.offset == b["n"]
        b["n"] += p.length
        b["s"].add(p.source)
        b["c"].add(p.cluster)


def test_packing_of_large_row_numbers(spark):
    """Row numbers of partitions beyond 1,024 (2**43 and more), full pieces among them."""
    rows = [((1 << 62) + i, i, p, 100 if p == 0 else 30, i % 3, i) for i in range(6) for p in range(2)]
    pieces = spark.createDataFrame(rows, "rid long, id long, piece int, length int, source long, cluster long")
    out = packing.pack_pieces(staged(pieces, "p"), 100).collect()
    bins = collections.defaultdict(list)
    for r in out:
        bins[r.bin].append(r)
    assert len(out) == 12 and all(sum(r.length for r in b) <= 100 for b in bins.values())
    assert sum(len(b) == 1 and b[0].length == 100 for b in bins.values()) == 6


def test_packing_documents(spark):
    df, n = awkward(spark)
    rows = packing.pack_documents(df, capacity=128, group_pieces=5).collect()
    assert len({(r.doc_id, r.piece) for r in rows if r.doc_id == 5}) == -(-len(df.filter("doc_id = 5").first().text.split()) // 128)
    assert sum(r.piece == 0 for r in rows) == n
    used = collections.Counter()
    for r in rows:
        used[r.bin] += r.end_token - r.first_token
    assert max(used.values()) <= 128
    assert packing.pack_documents(documents(spark, [])).collect() == []


def sizes_near(rows, shards):
    by = collections.Counter()
    slots = collections.defaultdict(list)
    for r in rows:
        by[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [by[i] for i in range(shards)]


def test_sharding(spark):
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.randint(5, 60))) for i in range(900)] + [(1000 + i, rows_text) for i, rows_text in enumerate(["hot text " * 30] * 500)]
    docs = documents(spark, rows)
    out = sharding.shard_documents(docs).collect()
    by = sizes_near(out, 8)
    assert max(by) - min(by) < 0.02 * sum(by) / 8 + 2 * max(r["size"] for r in out)
    text = dict(rows)
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r["size"] == len(text[r.doc_id].encode()) + 1 for r in out)
    df, n = awkward(spark)
    odd = sharding.shard_documents(df).collect()
    assert len(odd) == n and min(r["size"] for r in odd) == 1
    sizes_near(odd, 8)
    assert sharding.shard_documents(documents(spark, [])).collect() == []


def test_many_empty_texts_are_subdivided(spark, monkeypatch):
    """A third of all rows has no text: few bytes, many rows."""
    cells = []
    monkeypatch.setattr(sharding, "staged", lambda df, name: cells.append((name, staged(df, name))) or cells[-1][1])
    rng = random.Random(13)
    rows = [(i, prose(rng, 120)) for i in range(400)] + [(1000 + i, None if i % 2 else "") for i in range(200)]
    out = sharding.shard_records(sharding.staged(documents(spark, rows).select(
        F.col("doc_id").alias("rid"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size")), "shard-records"), 4, 8).collect()
    assert len(sizes_near(out, 4)) == 4 and len(out) == len(rows)
    windows = dict(cells)["shard-cells"].groupBy(sharding.OWN + "range", sharding.OWN + "part").count()
    assert windows.agg(F.max("count")).first()[0] < 3 * len(rows) / 32


def test_write_shards(spark, tmp_dir):
    docs = documents(spark, [(i, f"text {i} " * 9) for i in range(60)])
    placed = staged(sharding.shard_documents(docs, n_shards=3), "t")
    sharding.write_shards(docs, placed, tmp_dir + "/shards")
    back = spark.read.parquet(tmp_dir + "/shards")
    assert back.count() == 60 and back.select("shard").distinct().count() == 3


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.score_documents(docs, labels)
    rows = out.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.93
    worse = labels.withColumn("toxic", F.when(toxicity.fold_of("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score_documents(docs, worse).collect()}
    assert all(again[r.doc_id] == r.score for r in rows)


def test_toxicity_edges(spark):
    df, n = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score_documents(df, none).collect()
    assert len(rows) == n and all(r.score == 0 and r.predicted == 0 for r in rows)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    big = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = df.select(F.col("doc_id"), "text", "lang", "source", "n_chars").withColumn("doc_id", F.col("doc_id") + 10**9)
    out = toxicity.score_documents(big.unionByName(odd), labels)
    assert out.count() == big.count() + n
    same = [r.score for r in out.filter("doc_id IN (1000000005, 1000000006)").collect()]
    assert len(set(same)) == 1
    assert toxicity.score_documents(documents(spark, []), labels).collect() == []
