"""Secret scan with corpus-wide ownership frequency, as DataFrame operations.

Candidates are found in the whole text of each document.  Every candidate's
value is hashed, and the hashes are aggregated over the corpus by distinct
repositories and distinct owners: a value that more than ``MAX_OWNERS``
owners or more than ``MAX_REPOS`` repositories hold is a widely copied
example, one that few hold is a live-looking credential.  The fixed kinds
(assignments, access ids, hex strings) are always reported, with that class
beside them; strings of the broader kind ``key`` become spans only if they
look live.

Work is linear in a text's length and in its spans: offsets are running sums
over the matches as rows, and redaction joins stretches of the text.
Counts are exact and pre-aggregated by (hash, owner, repository), then by
(hash, owner), then by hash, so a value in a third of all documents is
counted in every task that holds it.  The classes come back by a join of two
stored tables, whose skewed partitions Spark splits at run time.

Cases: null and empty texts have no spans; a null owner or repository is one
unknown owner or repository; repeated rows and repeated ids are scanned and
reported row by row; ties between spans go by kind; an empty table gives an
empty result; extra columns are ignored by the report and kept by
``redact_secrets``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import OWN, any_case, staged, text_or_empty

MAX_OWNERS = 2
MAX_REPOS = 16
STRETCH = 4096
MIN_ASSIGNED = 6
PLACEHOLDER = "[SECRET]"

# The patterns of the kinds, in their order.
NAMES = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token", "api")).replace(
    any_case("api"), any_case("api") + "_?" + any_case("key"))
ASSIGN = "(" + NAMES + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEY = r"[A-Za-z0-9_-]{24,}"
KINDS = ("assign", "access", "hex", "key")
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, KEY), strict=True))
# A broader candidate needs a digit and letters of both cases.
KEY_PARTS = ("[0-9]", "[a-z]", "[A-Z]")

def _matches(text: Column, kind: str) -> Column:
    """All matches of a kind, in order, as (kind, no, gap, hit, good, value):
    the lengths of the text before the match and of the match in code points,
    whether it counts, and the hash of its value."""
    p, no = PATTERNS[kind], KINDS.index(kind)
    whole = F.regexp_extract_all(text, F.lit(p), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(p), F.lit(2)) if kind == "assign" else whole
    parts = F.arrays_zip(F.split(text, p, -1).alias("gap"), whole.alias("hit"), value.alias("val"))

    def match(x: Column, i: Column) -> Column:
        good = F.length(x["val"]) >= MIN_ASSIGNED if kind == "assign" else F.lit(True)
        for part in KEY_PARTS if kind == "key" else ():
            good = good & x["hit"].rlike(part)
        return F.struct(F.lit(no).alias("kind"), i.alias("no"), F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"),
                        good.alias("good"), F.sha2(x["val"].cast("binary"), 256).alias("value"))

    # The last piece of the split has no match after it.
    none = F.array().cast("array<struct<kind:int,no:int,gap:int,hit:int,good:boolean,value:string>>")
    found = F.transform(F.filter(parts, lambda x: x["hit"].isNotNull()), match)
    return F.when(text.rlike(p), found).otherwise(none)


def with_matches(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a row number and the matches of every kind."""
    df = docs.withColumn(OWN + "t", text_or_empty(text_col))
    matches = F.concat(*[_matches(F.col(OWN + "t"), k) for k in KINDS])
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], F.monotonically_increasing_id().alias(OWN + "rid"),
                     matches.alias(OWN + "matches"))


def candidates(scanned: DataFrame, owner_col: str, repo_col: str) -> DataFrame:
    """(rid, owner, repo, kind, start, stop, value) of the matches that count.
    A string of the broader kind that overlaps a span of the fixed kinds is
    dropped: neither a fixed span that starts no later ends after its start,
    nor does one that starts later start before its end."""
    rid, key = OWN + "rid", F.col("kind") == KINDS.index("key")
    rows = scanned.filter(F.size(OWN + "matches") > 0).select(
        rid, F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("")).alias("repo"), F.explode(OWN + "matches").alias("m"))
    rows = rows.select(rid, "owner", "repo", "m.*").repartition(rid)
    upto = Window.partitionBy(rid, "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("stop", F.sum(F.col("gap") + F.col("hit")).over(upto).cast("int"))
    rows = rows.withColumn("start", F.col("stop") - F.col("hit")).filter("good")
    # Both look back over an order: a frame to the end of the text is quadratic.
    before = (Window.unboundedPreceding, -1)
    upward = Window.partitionBy(rid).orderBy("start", "kind").rowsBetween(*before)
    downward = Window.partitionBy(rid).orderBy(F.desc("start"), F.desc("kind")).rowsBetween(*before)
    earlier = F.max(F.when(~key, F.col("stop"))).over(upward)
    later = F.min(F.when(~key, F.col("start"))).over(downward)
    rows = rows.withColumns({"earlier": earlier, "later": later})
    clear = (F.coalesce(F.col("earlier"), F.lit(0)) <= F.col("start")) & (F.col("later").isNull() | (F.col("later") >= F.col("stop")))
    return rows.filter(~key | clear).select(rid, "owner", "repo", "kind", "start", "stop", "value")


def ownership(values: DataFrame) -> DataFrame:
    """(value, repos, owners) from one row (value, owner, repo) a candidate."""
    by_repo = values.groupBy("value", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("value").agg(F.sum("repos").alias("repos"), F.count("*").alias("owners"))


def classified(scanned: DataFrame, owner_col: str, repo_col: str, max_owners: int, max_repos: int) -> DataFrame:
    """(rid, kind, start, stop, live, repos, owners) of the spans to report,
    from a stored table of ``with_matches``."""
    hits = staged(candidates(scanned, owner_col, repo_col), "secret-candidates")
    held = staged(ownership(hits.select("value", "owner", "repo")), "secret-owners")
    live = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    judged = hits.join(held, "value").withColumn("live", live)
    return judged.filter(F.col("live") | (F.col("kind") < KINDS.index("key"))).select(
        OWN + "rid", "kind", "start", "stop", "live", "repos", "owners")


def _digest(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s.kind), s.start.cast("string"), s.stop.cast("string"))), ",")


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                  repo_col: str = "doc_id", max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per document: counts of the fixed kinds, digests, how many of
    all spans look live or are copied examples, and the most repositories and
    owners that hold one of its values (0 without spans)."""
    keep = list(dict.fromkeys([id_col, text_col, owner_col, repo_col]))
    scanned = staged(with_matches(docs.select(*keep), text_col).drop(text_col), "secret-scan")
    span = F.struct("start", "kind", "stop", "live", "repos", "owners")
    spans = classified(scanned, owner_col, repo_col, max_owners, max_repos).groupBy(OWN + "rid").agg(
        F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,live:boolean,repos:bigint,owners:bigint>>")
    with_hits = scanned.filter(F.size(OWN + "matches") > 0).join(spans, OWN + "rid", "left")
    rows = with_hits.select(id_col, F.coalesce("spans", none).alias("s")).unionAll(
        scanned.filter(F.size(OWN + "matches") == 0).select(id_col, none.alias("s")))
    base = F.filter("s", lambda x: x.kind < KINDS.index("key"))

    def n(test) -> Column:
        return F.size(F.filter("s", test)).cast("long")

    def of_kind(no: int) -> Column:
        return n(lambda x: x.kind == no)

    def most(what: str) -> Column:
        return F.coalesce(F.array_max(F.transform("s", lambda x: x[what])), F.lit(0)).cast("long")

    return rows.select(
        id_col, *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:-1])],
        F.sha2(_digest(base).cast("binary"), 256).alias("base_sha256"), _digest(F.col("s")).alias("spans"),
        n(lambda x: x.live).alias("n_live"), n(lambda x: ~x.live).alias("n_example"),
        most("repos").alias("max_repos"), most("owners").alias("max_owners"))


def _cuts(live: DataFrame) -> DataFrame:
    """(rid, cuts): for each stretch of a text up to its last span, in order,
    the parts to leave out as (from, to, marks) within the stretch."""
    rid = OWN + "rid"
    before = F.max("stop").over(Window.partitionBy(rid).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1))
    # Overlapping spans are one: only the first of them sets a placeholder.
    spans = live.withColumn("before", F.coalesce(before, F.lit(0))).select(
        rid, F.greatest("start", "before").alias("start"), "stop", (F.col("start") >= F.col("before")).alias("marks")).filter(
        F.col("stop") > F.col("start"))
    at = spans.select("*", F.explode(F.expr(f"sequence(start div {STRETCH}, (stop - 1) div {STRETCH})")).alias("no"))
    low = F.col("no") * STRETCH
    cut = F.struct(F.greatest(F.col("start") - low, F.lit(0)).cast("int").alias("from"),
                   F.least(F.col("stop") - low, F.lit(STRETCH)).cast("int").alias("to"),
                   (F.col("marks") & (F.col("start") >= low)).alias("marks"))
    some = at.groupBy(rid, "no").agg(F.array_sort(F.collect_list(cut)).alias("cut"))
    # Every stretch up to the last has an entry, so that a position finds it.
    upto = spans.groupBy(rid).agg(F.max("stop").alias("stop")).select(
        rid, F.explode(F.expr(f"sequence(0L, (stop - 1) div {STRETCH})")).alias("no"),
        F.array().cast("array<struct<from:int,to:int,marks:boolean>>").alias("cut"))
    each = some.unionByName(upto).groupBy(rid, "no").agg(F.flatten(F.collect_list("cut")).alias("cut"))
    return each.groupBy(rid).agg(F.transform(F.array_sort(F.collect_list(F.struct("no", "cut"))), lambda x: x["cut"]).alias("cuts"))


def _without(piece: Column, cuts: Column) -> Column:
    """A stretch of text with its cuts left out."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, c: Column) -> Column:
        gap = F.substring(piece, acc.at + 1, c["from"] - acc.at)
        mark = F.when(c.marks, F.lit(PLACEHOLDER)).otherwise(F.lit(""))
        return F.struct(F.concat(acc.out, gap, mark).alias("out"), c["to"].alias("at"))

    return F.aggregate(cuts, start, step, lambda acc: F.concat(acc.out, F.substring(piece, acc.at + 1, F.lit(STRETCH))))


def redact_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", owner_col: str = "source",
                   repo_col: str = "doc_id", max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """``docs`` with every live-looking span replaced by a placeholder."""
    scanned = staged(with_matches(docs, text_col), "secret-docs")
    spans = classified(scanned, owner_col, repo_col, max_owners, max_repos)
    has = F.size(OWN + "matches") > 0
    hit = scanned.filter(has).join(_cuts(spans.filter("live")), OWN + "rid", "left")
    pieces = F.regexp_extract_all(text_or_empty(text_col), F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))
    redacted = F.array_join(F.transform(F.arrays_zip(pieces.alias("piece"), F.col("cuts").alias("cut")), lambda x: F.when(
        F.size(x["cut"]) > 0, _without(x["piece"], x["cut"])).otherwise(x["piece"])), "")
    hit = hit.withColumn(text_col, F.when(F.col("cuts").isNotNull(), redacted).otherwise(F.col(text_col)))
    if chars_col and chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        hit = hit.withColumn(chars_col, F.when(F.col("cuts").isNotNull(), F.length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return scanned.filter(~has).select(*cols).unionAll(hit.select(*cols))


def _oracle() -> str:
    def q(s: str) -> str:
        return s.replace("'", "''")

    found = []
    for no, kind in enumerate(KINDS):
        p, group = q(PATTERNS[kind]), 2 if kind == "assign" else 0
        found.append(f"""
  SELECT doc_id, owner, repo, {no} AS kind, i, gaps, hits, vals[i] AS val FROM (
    SELECT doc_id, owner, repo, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}', 0) AS hits,
      regexp_extract_all(t, '{p}', {group}) AS vals, unnest(range(1, len(regexp_extract_all(t, '{p}', 0)) + 1)) AS i
    FROM d)""")
    key = KINDS.index("key")
    good = " AND ".join(f"regexp_matches(val, '{p}')" for p in KEY_PARTS)
    name = f"['{"', '".join(KINDS)}'][kind + 1]"
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(CAST(doc_id AS VARCHAR), '') AS repo, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(found)}),
placed AS (
  SELECT doc_id, owner, repo, kind, sha256(val) AS value,
    list_sum(list_transform(gaps[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1 : i - 1], lambda x: length(x))), 0) AS start,
    list_sum(list_transform(gaps[1 : i], lambda x: length(x))) + list_sum(list_transform(hits[1 : i], lambda x: length(x))) AS stop
  FROM found WHERE CASE kind WHEN 0 THEN length(val) >= {MIN_ASSIGNED} WHEN {key} THEN {good} ELSE true END
), cands AS (
  SELECT * FROM placed k WHERE kind < {key} OR NOT EXISTS (
    SELECT 1 FROM placed b WHERE b.doc_id = k.doc_id AND b.kind < {key} AND b.start < k.stop AND k.start < b.stop)
), owned AS (
  SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repo)) AS repos FROM cands GROUP BY value
),
spans AS (
  SELECT doc_id, kind, start, owners, repos, owners <= {MAX_OWNERS} AND repos <= {MAX_REPOS} AS live,
    {name} || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS s
  FROM cands JOIN owned USING (value) WHERE kind < {key} OR (owners <= {MAX_OWNERS} AND repos <= {MAX_REPOS})
), per_doc AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex, string_agg(s, ',' ORDER BY start, kind) FILTER (kind < {key}) AS base,
    string_agg(s, ',' ORDER BY start, kind) AS spans, count(*) FILTER (live) AS n_live,
    count(*) FILTER (NOT live) AS n_example, max(repos) AS max_repos, max(owners) AS max_owners
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(max_repos, 0) AS max_repos, coalesce(max_owners, 0) AS max_owners
FROM d LEFT JOIN per_doc USING (doc_id)
"""


ORACLE = _oracle()
