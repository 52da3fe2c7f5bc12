"""Quality rules, URL filter, secret scan, chat formatting and containment against DuckDB."""

import random

import pytest
from pyspark.sql import functions as F

from emberlake.llm import chat, decontaminate, quality, secrets, urls
from tests.llm.helpers import awkward, documents, prose, same_rows


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.randint(5, 120))) for i in range(30)]
    part = prose(rng, 60)
    rows += [(100, None), (101, ""), (102, " \n \t"), (103, part + "\n" + part), (104, "of " * 50),
             (105, "a | b | c | d\n" * 9), (106, "Menu\nHome\nAbout us\n" * 9), (107, "Hi!! You!! Now!!\n" * 12),
             (108, part + "\nAll Rights Reserved by nobody at all here.\n" + "Terms of use\n" * 3),
             (109, "### a$$$ b%%% c&&& " * 9), (110, "é" * 30 + "\x0b" + "\u00a0 x" * 30), (111, part.replace("\n", "\r\n"))]
    return documents(spark, rows)


def test_quality_matches_sql(docs):
    same_rows(quality.quality_report(docs), quality.ORACLE, documents=docs)


def test_quality_keeps_prose_and_drops_junk(docs):
    kept = {r.doc_id: r.kept for r in quality.quality_report(docs).collect()}
    assert all(kept[i] for i in range(30) if i in kept and i > 0 and len(docs.filter(F.col("doc_id") == i).first().text.split()) >= 20)
    assert not any(kept[i] for i in (100, 101, 102, 103, 104, 105, 106, 107, 109))
    assert kept[108] and kept[111]


def test_cleaning_removes_failing_lines(docs):
    out = {r.doc_id: r for r in quality.clean_documents(docs).collect()}
    assert "Rights" not in out[108].text and "Terms" not in out[108].text
    assert out[108].n_chars == len(out[108].text)


def test_awkward_documents(spark):
    df, n = awkward(spark)
    q = quality.quality_report(df).collect()
    assert len(q) == n and not any(r.kept for r in q if r.n_words < 20)
    assert quality.clean_documents(df).columns == df.columns
    s = secrets.secret_report(df)
    rows = s.collect()
    assert len(rows) == n
    hit = next(r for r in rows if r.doc_id == 7)
    assert (hit.n_assign, hit.n_access, hit.n_hex) == (1, 1, 0) and hit.spans.startswith("assign:0:25")
    red = secrets.redact_secrets(df)
    assert red.columns == df.columns and red.count() == n
    assert red.filter("doc_id = 7").first().text.count(secrets.PLACEHOLDER) == 2


def test_empty_tables(spark):
    none = documents(spark, [])
    pages = spark.createDataFrame([], "page_id long, url string")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    one = documents(spark, [(1, "a b c d e f")])
    for df in (quality.quality_report(none), secrets.secret_report(none), secrets.redact_secrets(none),
               urls.judge_urls(pages), chat.chat_report(turns), decontaminate.contaminated(none, items),
               decontaminate.contaminated(one, items)):
        assert df.collect() == []
    assert decontaminate.drop_contaminated(one, items).count() == 1


def test_secrets_match_sql(spark):
    rng = random.Random(2)
    keys = ["password", "PassWd", "secret", "Token", "api_key", "APIKEY"]
    pool = ["".join(rng.choices("abcdef0123456789", k=rng.choice([20, 24, 40]))) for _ in range(8)]
    pool += ["AKIA" + "".join(rng.choices("ABCDEFGHIJ0123456789", k=16)), "AKIAAKIA12345", "ghp_aB3" + "xY9zQ" * 5, "abc"]
    rows = []
    for i in range(60):
        bits = []
        for _ in range(rng.randint(0, 6)):
            v = rng.choice(pool)
            bits.append(rng.choice([f'{rng.choice(keys)} = "{v}"', f"{rng.choice(keys)}:{v}", v, f"{v}{rng.choice(pool)}",
                                    f"{rng.choice(keys)}: {rng.choice(keys)}: {v}", "é\U0001f600 ü"]))
        rows.append((i, f" {rng.choice(['', 'x', '—'])} ".join(bits), f"s{i % 7}"))
    rows += [(100, None), (101, ""), (102, "token=" + "a" * 5), (103, "\u017fecret=abcdefgh pa\u212aword=abcdefgh")]
    df = documents(spark, rows)
    same_rows(secrets.secret_report(df), secrets.ORACLE, documents=df)


def test_ownership_separates_examples(spark):
    key, own = "c0ffee00" * 4, "deadbeef" * 4
    rows = [(i, f"token = {key}", f"s{i}") for i in range(5)] + [(9, f"token = {own}", "s1")]
    out = {r.doc_id: r for r in secrets.secret_report(documents(spark, rows)).collect()}
    assert out[0].n_example == 2 and out[0].n_live == 0 and out[9].n_live == 2
    red = {r.doc_id: r.text for r in secrets.redact_secrets(documents(spark, rows)).collect()}
    assert key in red[0] and red[9] == secrets.PLACEHOLDER


def test_repositories_separate_examples(spark):
    key = "c0ffee00" * 4
    rows = [(i, f"token = {key}", "s0") for i in range(secrets.MAX_REPOS + 1)]
    docs = documents(spark, rows)
    out = secrets.secret_report(docs).collect()
    assert all((r.n_live, r.n_example, r.max_repos, r.max_owners) == (0, 2, len(rows), 1) for r in out)
    assert all(r.n_live == 2 for r in secrets.secret_report(docs.filter("doc_id > 0")).collect())
    same_rows(secrets.secret_report(docs), secrets.ORACLE, documents=docs)


def test_many_spans_in_one_text(spark):
    """Spans across the borders of stretches, and a text of 100,000 spans."""
    rng = random.Random(6)
    texts = []
    for i in range(12):
        parts = []
        for _ in range(rng.randint(200, 400)):
            hex_digits = "".join(rng.choices("abcdef0123456789", k=rng.choice([24, 32, 5000 if i == 3 else 40])))
            parts.append(rng.choice(["é😀 plain words ", f"token = {hex_digits} ", f"{hex_digits}; ", f"secret:{hex_digits}\n"]))
        texts.append("".join(parts))
    docs = documents(spark, list(enumerate(texts)))
    spans = {r.doc_id: r.spans for r in secrets.secret_report(docs).collect()}
    got = {r.doc_id: r.text for r in secrets.redact_secrets(docs).collect()}
    for i, text in enumerate(texts):
        out, at = [], 0
        for start, stop in sorted(tuple(map(int, s.split(":")[1:])) for s in spans[i].split(",")):
            if start >= at:
                out += [text[at:start], secrets.PLACEHOLDER]
            at = max(at, stop)
        assert got[i] == "".join(out) + text[at:]
    long = " ".join(f"token = {i:030x}" for i in range(50_000))
    many = documents(spark, [(1, long)])
    row = secrets.secret_report(many).first()
    assert (row.n_assign, row.n_hex) == (50_000, 50_000)
    assert secrets.redact_secrets(many).first().text == " ".join([secrets.PLACEHOLDER] * 50_000)


def test_urls_match_sql(spark):
    rng = random.Random(3)
    hosts = ["a.example.org", "EXAMPLE.org", "x.example.com", "b.example.net", "org", "myorg", "c.com"]
    paths = ["", "/", "/es/1", "/en/12", "/en/2.html", "/fr/a?x=1", "/de/b#t", "/de", "/zz/Ü\U0001f600"]
    rows = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.randint(0, 99)}") for i in range(150)]
    rows += [(200, None), (201, ""), (202, "no scheme"), (203, "x://y://z/q"), (204, "http://"), (205, "http://example.org?x"),
             (206, "HTTP://A.Example.ORG/es/\nline"), (0, rows[0][1])]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("verdict", F.lit("x")).withColumn("rule", F.lit(1))
    same_rows(urls.judge_urls(pages), urls.ORACLE, pages=pages)
    out = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    assert out[205].rule is None and out[202].host == "" and out[203].host == "y:"


def test_url_rules(spark):
    pages = spark.createDataFrame([(1, "http://example.org/es/9"), (2, "http://a.example.org/en/1x"), (3, "http://example.org/en/2"),
                                   (4, "http://b.com/fr/"), (5, "http://b.com/de/1"), (6, "http://notexample.org/es/1")],
                                  "page_id long, url string")
    out = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages).collect()}
    assert out == {1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("org/", "allow"),
                   4: ("com/fr/", "allow"), 5: ("com/de/", "block"), 6: ("org/", "allow")}


def test_chat_matches_sql(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi é\U0001f600"), (1, 2, "bob", None), (1, 3, "ann", "<|im_end|> x"),
            (1, 3, "ann", "<|im_end|> x"), (1, 3, "bob", "tie"), (2, 0, "system", "alone"), (None, None, None, "lost"),
            (None, 5, "a b\nc", ""), (3, 5000, "ann", "late"), (3, 1, "cy", "early"), (4, -1, "ann", "neg")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(7))
    same_rows(chat.chat_report(turns), chat.ORACLE, conversations=turns)
    out = chat.rotate_perspectives(turns).collect()
    for r in out:
        for m in r.masks:
            assert r.rendered[m.start:m.stop].endswith(chat.CLOSE)
    assert {r.perspective for r in out if r.conv_id == 1} == {"ann", "bob"}
    assert {r.part for r in out if r.conv_id == 3} == {0}


def test_chat_parts_are_bounded(spark):
    rows = [(None, None if i % 3 else i % 7, f"s{i % 2}", "same" if i % 4 else f"t{i}") for i in range(5000)]
    rows += [(7, 1, "ann", "x")] * 3000 + [(i, 0, "bob", "short") for i in range(8, 40)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    same_rows(chat.chat_report(turns), chat.ORACLE, conversations=turns)
    out = chat.rotate_perspectives(turns, hot=8).select("conv_id", "part", "n_turns").collect()
    assert max(r.n_turns for r in out) == chat.PART_TURNS
    assert sorted(r.part for r in out if r.conv_id == 7) == [0, 1, 2]


def test_containment_matches_sql(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.choice([1, 5, 9, 20, 60]))) for i in range(40)] + [(90, None), (91, ""), (92, "one two three")]
    rows = [(i, prose(rng, 300) + "\n" + items[i % 40][1].upper() + "\n" + prose(rng, 3000 if i % 10 == 0 else 30)) for i in range(50)]
    rows += [(100, None), (101, ""), (102, "One, two; three!"), (103, items[3][1]), (103, items[3][1]), (None, items[4][1])]
    rows += [(104, " ".join(items[25][1].split()[:-2])), (105, "one two three four five")]
    docs = documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    unique = docs.filter("doc_id IS NOT NULL").dropDuplicates()
    same_rows(decontaminate.contaminated(unique, bench), decontaminate.ORACLE, documents=unique, benchmark=bench)
    pairs = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()]
    assert pairs.count((103, 3)) == 2 and (None, 4) in pairs and (102, 92) in pairs
    kept = decontaminate.drop_contaminated(docs, bench)
    assert {r.doc_id for r in kept.collect()} == {100, 101, 104, 105} - {p[0] for p in pairs}


def test_items_that_repeat_themselves_match_sql(spark):
    rng = random.Random(12)
    refrains = [f"left{i} right{i} " * 34 for i in range(25)]
    refrains += [" ".join(f"r{i}x{k % 8}" for k in range(68)) for i in range(25)]
    items = spark.createDataFrame(list(enumerate(refrains)), "item_id long, text string")
    docs = documents(spark, [(i, prose(rng, 90) + "\n" + t + "\n" + prose(rng, 90)) for i, t in enumerate(refrains)])
    same_rows(decontaminate.contaminated(docs, items), decontaminate.ORACLE, documents=docs, benchmark=items)
    assert decontaminate.drop_contaminated(docs, items).count() == 0
