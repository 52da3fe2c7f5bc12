"""The corpus pipeline against a plain Python version of its stages."""

import collections
import re

import corpus_pipeline
from emberlake.llm import decontaminate, neardup, packing, quality, secrets
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, documents, plain_shingles
from tests.llm.test_arrays import plain_classes

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_quality(text):
    """The cleaned text, or None if the document is rejected."""
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    if len(words) < 20 or 100 * len(inside) > 30 * len(words):
        return None
    kept = []
    for line in text.split("\n"):
        n = len(WORD.findall(line))
        bad = n and ((n < 6 and not re.search(quality.CLOSED.replace("$", r"\Z"), line))
                     or len(re.findall(quality.SHOUT, line)) * 5 > n or len(re.findall(quality.SYMBOLS, line)) * 2 > n
                     or len(re.findall(quality.SEPARATORS, line)) * 3 > n or re.search(quality.BOILERPLATE, line))
        if not bad:
            kept.append(line)
    chars = sum(map(len, words))
    left = sum(map(len, WORD.findall("\n".join(kept))))
    return "\n".join(kept) if 100 * left >= 50 * chars else None


def plain_redaction(docs):
    """docs: {id: (text, source)} -> {id: text} with live-looking spans masked."""
    found, owners = collections.defaultdict(list), collections.defaultdict(set)
    for d, (text, source) in docs.items():
        base = []
        for kind in secrets.KINDS:
            for m in re.finditer(secrets.PATTERNS[kind], text):
                value = m.group(2) if kind == "assign" else m.group(0)
                if kind == "assign" and len(value) < 6:
                    continue
                if kind == "key" and (not all(re.search(p, value) for p in secrets.KEY_PARTS)
                                      or any(a < m.end() and m.start() < b for a, b in base)):
                    continue
                if kind != "key":
                    base.append(m.span())
                found[d].append((*m.span(), value))
                owners[value].add(source)
    out = {}
    for d, (text, _) in docs.items():
        spans = sorted((a, b) for a, b, v in found[d] if len(owners[v]) <= secrets.MAX_OWNERS)
        done, at = "", 0
        for a, b in spans:
            if a >= at:
                done, at = done + text[at:a] + secrets.PLACEHOLDER, b
            at = max(at, b)
        out[d] = done + text[at:]
    return out


def test_run_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    source = {r.doc_id: r.source for r in docs}
    cleaned = [(r.doc_id, plain_quality(r.text)) for r in docs]
    cleaned = [(d, t) for d, t in cleaned if t is not None]
    classes = plain_classes(cleaned)
    unique = [(d, t) for (d, t), c in zip(cleaned, classes, strict=True) if d == c]
    items = [set(plain_shingles(r.text)) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = []
    for d, t in unique:
        held = set(plain_shingles(t))
        if not any(s and len(s & held) >= decontaminate.THRESHOLD * len(s) for s in items):
            clean.append((d, t))
    final = plain_redaction({d: (t, source[d]) for d, t in clean})
    want = collections.Counter()
    for d, t in final.items():
        n = len(WORD.findall(t))
        for p in range(max(1, -(-n // packing.CAPACITY))):
            want[d, p, p * packing.CAPACITY, min(n, (p + 1) * packing.CAPACITY)] += 1
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert collections.Counter((r.doc_id, r.piece, r.first_token, r.end_token) for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.bin].append(r)
    for members in bins.values():
        at = 0
        for r in sorted(members, key=lambda r: (r.offset, r.end_token - r.first_token)):
            assert r.offset == at
            at += r.end_token - r.first_token
        assert at <= packing.CAPACITY
        assert len({source[r.doc_id] for r in members}) == len(members)


def test_stages_keep_the_columns_and_survive_awkward_documents(spark):
    df, _ = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF_SMALL)
        rows = out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == df.columns
        assert rows or name == "quality_rules"


def test_stages_on_an_empty_table(spark):
    none = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF_SMALL).collect() == []


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5 and neardup.THRESHOLD == 0.8
