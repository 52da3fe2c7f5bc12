"""Fixtures and plain versions shared by the tests of the training-data operators."""

from __future__ import annotations

import random
import re

import duckdb

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves.
CLASHING = ("kept", "node", "id", "rid", "key", "shard", "slot", "bin", "value", "spans", "score", "label", "chunk",
            "cluster", "size", "t", "text_crc32", "piece", "root", "host", "rule")
WORDS = [f"w{i}" for i in range(400)]


def prose(rng: random.Random, n: int) -> str:
    out = []
    while len(out) < n:
        out.append(" ".join(rng.choice(WORDS) for _ in range(rng.randint(6, 12))).capitalize() + ".")
        n -= 7
    return "\n".join(out)


def documents(spark, rows):
    """rows of (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def awkward(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    one hot source and extra columns with clashing names."""
    long_text = prose(random.Random(5), 30_000)
    rows = [(None, None, None, None, None), (None, "", "en", "s", 0), (1, None, None, "s", None), (2, "", "en", None, 0),
            (3, "   \n\t ", "en", "s", 6), (4, "one two", "en", "s", 7), (4, "one two", "en", "s", 7),
            (5, long_text, "en", "s", len(long_text)), (6, long_text, "en", "s", len(long_text)),
            (None, long_text, "en", "s", 1), (7, 'token = "abcdef0123456789" é\U0001f600 AKIA' + "A" * 20, "en", "s", 60),
            (8, "x" * 5000, "en", "s", 5000), (-9, "ß ü ñ " * 40, "de", "s", 240)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING}), len(rows)


def in_duckdb(sql: str, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    res = con.execute(sql)
    cols = [c[0] for c in res.description]
    return cols, res.fetchall()


def same_rows(df, sql: str, **tables) -> None:
    cols, want = in_duckdb(sql, **tables)
    assert sorted(cols) == sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def plain_words(text: str) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[a-z0-9\x80-\U0010ffff]+", lowered)


def plain_shingles(text: str) -> list[tuple]:
    w = plain_words(text)
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
