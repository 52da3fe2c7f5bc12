"""Source schedule, prefix trie and structure repair: SQL, plain versions, awkward inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from emberlake.llm import mixing, repair, trie
from tests.llm.helpers import awkward, documents, prose, same_rows

TURNS = "conv_id long, turn long, role string, text string"
FAULTS = {repair.SOUND: "", repair.BLANK: "blank", repair.DUPLICATE: "duplicate", repair.TRUNCATED: "truncated"}


def some_turns(spark, seed=3, convs=60, nulls=False):
    rng = random.Random(seed)
    rows = []
    for c in [*range(convs), *([None] if nulls else [])]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, rng.choice([t, t, t, None, 0]), rng.choice(["user", "assistant", "system", "tool", None, ""]),
                         rng.choice(["a.", "b!", "é", None, "", "x?\n ", " \t"])))
    return spark.createDataFrame(rows, TURNS)


# --- op11

@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(1, 300)), rng.choice(["a", "b", "b", "b", "é", "Z", None])) for i in range(120)]
    rows += [(7, "one two three", "a")] * 9 + [(200, None, "b"), (201, "", None), (None, "x y", "only"), (None, "x y", "only")]
    return documents(spark, rows)


def test_mix_matches_sql(mixed):
    same_rows(mixing.mix_report(mixed), mixing.ORACLE, documents=mixed)


def test_mix_meets_targets_and_reruns_agree(mixed):
    one = mixing.mix_report(mixed).collect()
    again = mixing.mix_report(mixed.repartition(5), block_words=mixing.BLOCK_WORDS).collect()
    assert sorted(map(repr, one)) == sorted(map(repr, again))
    taken = defaultdict(int)
    for r in one:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source_size, r.target] += r.taken
    assert all(abs(n - target) <= 0.5 for (_, target), n in taken.items())


def plain_targets(sizes, weights):
    """Shares by repeated resharing; sizes in order of the sources."""
    target, full, left = [0.0] * len(sizes), set(), 1.5 * sum(sizes)
    while True:
        open_ = [i for i in range(len(sizes)) if i not in full]
        share = {i: left * weights[i % 3] / sum(weights[j % 3] for j in open_) for i in open_}
        over = [i for i in open_ if share[i] > 2 * sizes[i]]
        if not over:
            return [share.get(i, 2.0 * sizes[i]) for i in range(len(sizes))]
        for i in over:
            full.add(i)
            left -= 2 * sizes[i]


def test_targets_equal_repeated_resharing(spark):
    rng = random.Random(8)
    for _ in range(3):
        sizes = [rng.choice([1, 5, 40, 400]) for _ in range(rng.randint(1, 9))]
        docs = documents(spark, [(i, "w " * n, f"s{i}") for i, n in enumerate(sizes)])
        got = {r.doc_id: r.target for r in mixing.mix_report(docs).select("doc_id", "target").collect()}
        assert [got[i] for i in range(len(sizes))] == pytest.approx(plain_targets(sizes, (3, 1, 2)))


def test_every_stretch_of_the_schedule_is_near_the_weights(spark):
    targets = spark.createDataFrame([(0, 500 * 1024), (1, 300 * 1024), (2, 200 * 1024 - 5)], "no long, quota long")
    slots = sorted(tuple(r) for r in mixing.schedule(targets).select("slot", "no", "rank").collect())
    assert [s for s, *_ in slots] == list(range(1000))
    seen = Counter()
    for i, (_, no, rank) in enumerate(slots, 1):
        assert rank == seen[no]
        seen[no] += 1
        assert all(abs(seen[k] - i * w) <= 6 for k, w in ((0, .5), (1, .3), (2, .2)))


def test_slot_texts_hold_the_blocks(mixed):
    rows, pieces = mixing.mix_documents(mixed, block_words=64)
    texts = mixing.slot_texts(mixed, pieces).collect()
    words = sum(len(r.text.split()) for r in texts)
    assert words == sum(round(t) for t in {(r.no, r.target) for r in rows.collect()} for t in t[1:])
    assert max(len(r.text.split()) for r in texts) == 64


def test_mix_of_awkward_and_empty(spark):
    df, n = awkward(spark)
    out = mixing.mix_report(df).collect()
    assert len(out) == n and all(r.taken <= 2 * r.size for r in out)
    assert mixing.mix_report(documents(spark, [])).collect() == []
    nothing = mixing.mix_report(documents(spark, [(1, None), (2, " ")])).collect()
    assert [(r.target, r.taken) for r in nothing] == [(0.0, 0), (0.0, 0)]


def test_repeated_rows_are_dealt_out(spark):
    from emberlake.llm.ordered import counted_out
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a", 10), ("b", 0), ("c", 3)], "k string, n long")
    out = counted_out(df, F.col("n"), "i", step=4).collect()
    assert sorted((r.k, r.i) for r in out) == [("a", i) for i in range(10)] + [("c", i) for i in range(3)]


# --- op12

def plain_trie(rows):
    conv = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            conv[c].append((t is not None, t or 0, hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), r, x))
    turns = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in conv.items()}
    members = defaultdict(list)
    length = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = turns.get(c - c % 5, [])[:h] + own[h:]
        length[c] = len(seq)
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             hashlib.sha256(",".join(str(c) for c in sorted(m) if length[c] == len(p)).encode()).hexdigest())
            for p, m in members.items()]


@pytest.mark.parametrize("cells", [trie.SHARD_CELLS, 30, 1])
def test_trie_equals_plain_version_at_any_shard_size(spark, cells):
    df = some_turns(spark, nulls=True)
    got = trie.trie_report(df, cells)
    want = plain_trie([tuple(r) for r in df.collect()])
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_trie_matches_sql(spark):
    df = some_turns(spark, seed=5)
    same_rows(trie.trie_report(df, 40), trie.ORACLE, conversations=df)


def test_many_equal_conversations_and_a_long_one(spark):
    rows = [(5 * c, t, "user", f"same {t}") for c in range(9000) for t in range(2)]
    rows += [(50_000, t, "user", f"turn {t}") for t in range(3000)]
    rows.append((50_001, 0, "user", "x"))
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'extra' AS key", "1 AS shard", "'p' AS path")
    out = {(r.depth, r.conv_id): r for r in trie.trie_report(df, 5000).collect()}
    assert out[0, 0].n_convs == 9002 and out[2, 0].n_convs == 9000 and len(out) >= 3003
    ids = ",".join(str(5 * c) for c in range(9000))
    assert out[2, 0].ends_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert out[0, 0].saved_tokens == sum(r.saved_tokens for k, r in out.items() if k[0] == 1)


def test_empty_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert trie.trie_report(none).collect() == [] and repair.repair_report(none).collect() == []


def test_conversation_without_turns_ends_at_the_root(spark):
    c = next(i for i in range(1, 500) if i % 5 and zlib.crc32(str(i).encode()) % 9 > 1)
    (root,) = trie.trie_report(spark.createDataFrame([(c, 0, "user", "a")], TURNS)).collect()
    assert (root.conv_id, root.depth, root.n_convs, root.n_leaves) == (c, 0, 1, 1)
    assert root.ends_sha256 == hashlib.sha256(str(c).encode()).hexdigest()


# --- op13

def plain_edits(rows):
    """(cost, audit) by a search over whole audits from the last turn to the first."""
    states, far = "ESUA", (10 ** 9, "")
    onward = {"E": "U", "S": "U", "U": "A", "A": "U"}
    keep = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}

    def inserted(v):
        for _ in range(3):
            v = {s: min(v[s], (v[onward[s]][0] + 5, "I" + v[onward[s]][1])) for s in states}
        return v

    v = inserted({"E": (0, ""), "A": (0, ""), "S": far, "U": far})
    for initial, fault in reversed(rows):
        new = {}
        for s in states:
            ways = [(v[s][0] + 2, "D" + v[s][1])]
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                ways += [(c + more, "K" + a) for c, a in [v[keep[s, initial]]]] if (s, initial) in keep else []
                ways.append((v[onward[s]][0] + 1 + more, "R" + v[onward[s]][1]))
            new[s] = min(ways)
        v = inserted(new)
    return v["E"]


def plain_repair(table):
    convs = defaultdict(list)
    for c, t, r, x in table:
        r, x = (" " if z is None else z for z in (r, x))
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if fate == 1 else re.sub("[.!?]", "", x) if fate == 2 else x
        r = "user" if fate == 4 else r
        digest = hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
        convs[c] += [(t is not None, t or 0, r, digest, x, t)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = []
    for c, rows in convs.items():
        rows.sort(key=lambda z: z[:4])
        numbers = [z[5] for z in rows if z[5] is not None]
        seen, classes = set(), []
        for _, _, r, _, x, _ in rows:
            core = x.strip(" \t\n\x0b\x0c\r")
            classes.append((r[:1], "blank" if not core else "duplicate" if (r, x) in seen else
                            "truncated" if core[-1] not in ".!?" else ""))
            seen.add((r, x))
        counts = Counter(f for _, f in classes)
        cost, audit = plain_edits(classes)
        done, todo = [], iter(rows)
        for e in audit:
            other = "assistant" if done and done[-1][0][:1] == "u" else "user"
            row = None if e == "I" else next(todo)
            if e != "D":
                done.append((other if e in "IR" else row[2], row[4] if row else ""))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in done))
        out.append((c, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, counts["blank"], counts["duplicate"],
                    counts["truncated"], sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(classes, classes[1:])), cost,
                    audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in done).encode()).hexdigest()))
    return out


def test_two_searches_find_the_least_audit_of_the_cheapest():
    rng = random.Random(6)
    for _ in range(1500):
        rows = [(rng.randint(0, 3), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 12))]
        codes = bytes(repair._code(*r) for r in rows)
        want = plain_edits([("suax"[k], FAULTS[f]) for k, f in rows])
        assert repair.repair_edits(codes) == want
        assert repair.repair_edits(codes, run=rng.randint(1, 4)) == want


@pytest.mark.parametrize("run", [repair.RUN, 2])
def test_repair_equals_plain_version(spark, run):
    df = some_turns(spark, seed=9, convs=150, nulls=True)
    cols = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = sorted((tuple(r[c] for c in cols) for r in repair.repair_report(df, run).collect()), key=repr)
    assert got == sorted(plain_repair([tuple(r) for r in df.collect()]), key=repr)


def test_repair_matches_sql(spark):
    df = some_turns(spark, seed=11)
    same_rows(repair.repair_report(df), repair.ORACLE, conversations=df)


def test_a_long_conversation_and_extreme_turn_numbers(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", 64)
    rng = random.Random(12)
    rows = [(1, t, rng.choice(["user", "assistant", "tool"]), f"text {rng.randint(0, 900)}" + rng.choice([".", "", "!"])) for t in range(1500)]
    rows += [(2, -(1 << 63), "user", "a."), (2, (1 << 63) - 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "'extra' AS at", "1 AS first", "'p' AS codes")
    got = {r.conv_id: r for r in repair.repair_report(df, run=200).collect()}
    want = {r[0]: r for r in plain_repair(rows)}
    assert (got[1].cost, got[1].audit, got[1].repaired_sha256) == (want[1][6], want[1][7], want[1][8])
    assert got[2].gaps in (0, (1 << 63) - 1)


def test_repaired_turns_are_sound(spark):
    ordered, edits, repaired = repair.repair_conversations(repair.damage(some_turns(spark, seed=13)))
    roles = defaultdict(list)
    for r in repaired.orderBy("at", "place").collect():
        roles[r.conv].append(r.role[0])
    assert roles and all(re.fullmatch("s?(ua)+", "".join(x)) for x in roles.values())
