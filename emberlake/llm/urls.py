"""URL filter: rules first, then a ratio of character language models.

URLs that a rule decides are the training text: one model of accepted and
one of rejected URLs.  Each is a variable-order Markov model: the longest
context of up to ``ORDER`` characters that the class has seen predicts the
next character, and Witten-Bell smoothing passes weight to the shorter
contexts and at last to the uniform distribution.  A URL's score is the sum
of the per-character log-likelihood differences divided by its length.  The
cut is calibrated on the fifth of the decided URLs that the models do not
learn from: the score that separates accepted from rejected with the highest
balanced accuracy (the lowest such cut on ties).

Everything is SQL.  The models are stored tables with a row for each n-gram
of the corpus, so what they gather grows with it.  Work is done once a
distinct URL; n-grams are counted before they are shuffled.  Scores come from
a join of the URLs' windows (a context and its character) with the windows'
ratios.  A window may stand in every URL: those with at least one of
``OFTEN`` parts of all occurrences, so at most ``OFTEN`` windows, are
broadcast, and no other holds more than that part of the shuffled rows.  Log
ratios are whole micro-nats: sums do not depend on their order.

Cases: a null URL or one without ``://`` has an empty host and path, no rule,
and is judged like any other; characters outside the alphabet share one
symbol, capitals are lower-cased; equal URLs get equal verdicts; with no
decided URLs both models are uniform, every score is 0 and the cut 0, so
undecided URLs are accepted; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import OWN, staged

# The rules, as (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# Symbols: these, ``OTHER`` for any other character and ``END``; ``PAD`` stands
# before the start and is never predicted.
SYMBOLS = "a-z0-9/._?=&#%:+~-"
PAD, END, OTHER = "^", "$", "!"
ALPHABET = 26 + 10 + 12 + 2
ORDER = 6
OFTEN = 4096
STRETCH = 4096
SCALE = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST_PATH = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rule_parts(rules):
    for verdict, rule in rules:
        cut = rule.index("/")
        yield verdict, rule, rule[:cut], rule[cut:]


def rule_case(rules, what: str, host: str, path: str, starts: str) -> str:
    """SQL: the longest fitting rule's text or verdict, null if none fits."""
    whens = []
    for verdict, rule, h, p in sorted(_rule_parts(rules), key=lambda r: (-len(r[1]), r[1])):
        fits = f"({host} = {_q(h)} OR {host} LIKE {_q('%.' + h)}) AND {starts}({path}, {_q(p)})"
        whens.append(f"WHEN {fits} THEN {_q(rule if what == 'rule' else verdict)}")
    return f"CASE {' '.join(whens)} END"


def with_rules(pages: DataFrame, url_col: str, rules) -> DataFrame:
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    df = pages.withColumn(OWN + "url", url)
    host = F.translate(F.regexp_extract(OWN + "url", HOST_PATH, 1), UPPER, LOWER)
    df = df.withColumn(OWN + "host", host).withColumn(OWN + "path", F.regexp_extract(OWN + "url", HOST_PATH, 2))
    return df.withColumns({
        OWN + "rule": F.expr(rule_case(rules, "rule", OWN + "host", OWN + "path", "startswith")),
        OWN + "by_rule": F.expr(rule_case(rules, "verdict", OWN + "host", OWN + "path", "startswith")),
    })


def _symbols(url: str, flags: str = "") -> str:
    """SQL: the symbols of ``url`` after ``ORDER`` pads and before an end."""
    folded = f"translate({url}, '{UPPER}', '{LOWER}')"
    return f"concat('{PAD * ORDER}', regexp_replace({folded}, '[^{SYMBOLS}]', '{OTHER}'{flags}), '{END}')"


def windows(urls: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and each window ``w``: ``ORDER`` symbols and the one they
    predict.  A long URL is cut into overlapping stretches first."""
    text, piece = OWN + "symbols", OWN + "piece"
    cut = urls.select(*keep, F.explode(F.expr(
        f"transform(sequence(1, length({text}) - {ORDER}, {STRETCH}), i -> substr({text}, i, {STRETCH + ORDER}))")).alias(piece))
    return cut.select(*keep, F.explode(F.expr(
        f"transform(sequence(1, length({piece}) - {ORDER}), i -> substr({piece}, i, {ORDER + 1}))")).alias("w"))


# The model as SQL for either engine.  ``counts`` has a row for each n-gram
# ``w`` of 1 to ORDER + 1 symbols: how often accepted and rejected training
# URLs hold it, and distinct URLs of any kind.  With t different symbols seen n
# times after a context, an n-gram seen k times has probability
# (k + t * that of the n-gram without its first symbol) / (n + t).
def stats_sql(counts: str) -> str:
    return f"""
SELECT c.w, length(c.w) AS len, c.allow, c.block, c.seen, x.na, x.ta, x.nb, x.tb
FROM {counts} c JOIN (
  SELECT substr(w, 1, length(w) - 1) AS ctx, sum(allow) AS na, sum(CASE WHEN allow > 0 THEN 1 ELSE 0 END) AS ta,
    sum(block) AS nb, sum(CASE WHEN block > 0 THEN 1 ELSE 0 END) AS tb
  FROM {counts} GROUP BY 1) x ON x.ctx = substr(c.w, 1, length(c.w) - 1)"""


def ratio_sql(stats: str) -> str:
    def smoothed(k: str, n: str, t: str, shorter: str) -> str:
        return f"CASE WHEN {t} = 0 THEN {shorter} ELSE ({k} + {t} * {shorter}) / ({n} + {t}) END"

    sql, uniform = "", f"(1.0e0 / {ALPHABET})"
    for n in range(1, ORDER + 2):
        pa, pb = ("q.pa", "q.pb") if sql else (uniform, uniform)
        shorter = f" JOIN ({sql}) q ON q.w = substr(s.w, 2)" if sql else ""
        sql = (f"SELECT s.w, s.seen, {smoothed('allow', 'na', 'ta', pa)} AS pa, {smoothed('block', 'nb', 'tb', pb)} AS pb"
               f" FROM {stats} s{shorter} WHERE s.len = {n}")
    return f"SELECT w, seen, CAST(round((ln(pa) - ln(pb)) * {SCALE}) AS BIGINT) AS micro FROM ({sql}) p"


def ngram_counts(urls: DataFrame) -> DataFrame:
    """(w, allow, block, seen) of the n-grams of all lengths.  ``urls`` has one
    row for each distinct URL: its verdict by rule, whether the models learn
    from it, and its number of pages."""
    learns = F.col(OWN + "learns")
    full = windows(urls.withColumns({
        "allow": F.when(learns & (F.col(OWN + "by_rule") == "allow"), F.col(OWN + "pages")).otherwise(0),
        "block": F.when(learns & (F.col(OWN + "by_rule") == "block"), F.col(OWN + "pages")).otherwise(0),
    }), ["allow", "block"])
    sums = [F.sum("allow").alias("allow"), F.sum("block").alias("block")]
    whole = staged(full.groupBy("w").agg(*sums, F.count("*").alias("seen")), "url-windows")
    ends = whole.select("allow", "block", "seen", F.explode(F.expr(
        f"transform(sequence(1, {ORDER + 1}), i -> substr(w, i))")).alias("w"))
    return ends.groupBy("w").agg(*sums, F.sum("seen").alias("seen"))


def window_ratios(urls: DataFrame) -> DataFrame:
    """(w, seen, micro): the log ratio of each window that a URL holds."""
    spark = urls.sparkSession
    counts = staged(ngram_counts(urls), "url-ngrams")
    stats = staged(spark.sql(stats_sql("{counts}"), counts=counts), "url-stats")
    return staged(spark.sql(ratio_sql("{stats}"), stats=stats), "url-ratios")


def url_sums(urls: DataFrame, ratio: DataFrame) -> DataFrame:
    """(rid, total) of the ratios over each URL's windows."""
    total = ratio.agg(F.sum("seen").alias("n")).first().n or 0
    often = F.col("seen") * OFTEN >= total
    common = F.broadcast(ratio.filter(often).select("w", "micro"))  # at most OFTEN rows
    rare = ratio.filter(~often).select("w", "micro")
    every = windows(urls, [OWN + "rid"])
    by_common = every.join(common, "w").groupBy(OWN + "rid").agg(F.sum("micro").alias("micro"))
    by_rare = every.join(common, "w", "left_anti").join(rare, "w").groupBy(OWN + "rid").agg(F.sum("micro").alias("micro"))
    return by_common.unionAll(by_rare).groupBy(OWN + "rid").agg(F.sum("micro").alias(OWN + "sum"))


CALIBRATES = "substr(md5({url}), 1, 1) < '3'"  # 3 of 16 decided URLs

# Cut from histogram(score, yes, no): accept from the score up.  Scores are whole
# thousandths of a nat a character, some tens of thousands of values at most.
CUT_SQL = """
SELECT score FROM (
  SELECT score,
    sum(yes) OVER (ORDER BY score ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * 1.0e0 / greatest(1, sum(yes) OVER ())
    + coalesce(sum(no) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 1.0e0
      / greatest(1, sum(no) OVER ()) AS gain
  FROM {histogram}
) ORDER BY gain DESC, score LIMIT 1
"""


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """page id, host, path, rule, verdict and score (in thousandths of a nat)."""
    spark = pages.sparkSession
    of_page = pages.select(F.col(id_col), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias(OWN + "url"))
    distinct = with_rules(of_page.groupBy(OWN + "url").agg(F.count("*").alias(OWN + "pages")), OWN + "url", rules)
    calibrates = F.expr(CALIBRATES.format(url=OWN + "url"))
    decided = F.col(OWN + "by_rule").isNotNull()
    urls = staged(distinct.select("*", F.expr(_symbols(OWN + "url")).alias(OWN + "symbols"), (decided & ~calibrates).alias(OWN + "learns"),
                                  F.monotonically_increasing_id().alias(OWN + "rid")), "urls")
    n = F.length(OWN + "symbols") - ORDER
    scored = staged(urls.join(url_sums(urls, window_ratios(urls)), OWN + "rid").withColumn(
        "score", F.floor(F.col(OWN + "sum") / (F.lit(1000.0) * n)).cast("long")).drop(OWN + "symbols"), "url-scores")
    page_sum = F.sum(F.col(OWN + "pages"))
    histogram = (scored.filter(decided & ~F.col(OWN + "learns")).groupBy("score", OWN + "by_rule").agg(page_sum.alias("n"))
                 .groupBy("score").agg(F.sum(F.when(F.col(OWN + "by_rule") == "allow", F.col("n")).otherwise(0)).alias("yes"),
                                       F.sum(F.when(F.col(OWN + "by_rule") == "block", F.col("n")).otherwise(0)).alias("no")))
    best = spark.sql(CUT_SQL, histogram=histogram).first()
    by_model = F.when(F.col("score") >= (best.score if best else 0), "allow").otherwise("block")
    judged = scored.withColumn(OWN + "verdict", F.coalesce(F.col(OWN + "by_rule"), by_model))
    return of_page.join(judged, OWN + "url").select(
        id_col, F.col(OWN + "host").alias("host"), F.col(OWN + "path").alias("path"),
        F.col(OWN + "rule").alias("rule"), F.col(OWN + "verdict").alias("verdict"), "score")


def _oracle() -> str:
    calibrates = CALIBRATES.format(url="url")
    return f"""
WITH src AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
parts AS (
  SELECT url, pages, translate(regexp_extract(url, '{HOST_PATH}', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(url, '{HOST_PATH}', 2) AS path FROM (SELECT url, count(*) AS pages FROM src GROUP BY url)
), ruled AS (
  SELECT *, {rule_case(RULES, 'rule', 'host', 'path', 'starts_with')} AS rule,
    {rule_case(RULES, 'verdict', 'host', 'path', 'starts_with')} AS by_rule, {_symbols('url', ", 'g'")} AS symbols FROM parts
), held AS (
  SELECT url, substr(symbols, i, {ORDER + 1}) AS w, CASE WHEN NOT {calibrates} AND by_rule = 'allow' THEN pages ELSE 0 END AS allow,
    CASE WHEN NOT {calibrates} AND by_rule = 'block' THEN pages ELSE 0 END AS block
  FROM (SELECT *, unnest(range(1, length(symbols) - {ORDER} + 1)) AS i FROM ruled)
), counts AS (
  SELECT substr(w, i) AS w, sum(allow) AS allow, sum(block) AS block, sum(seen) AS seen
  FROM (SELECT w, sum(allow) AS allow, sum(block) AS block, count(*) AS seen FROM held GROUP BY w), range(1, {ORDER + 2}) r(i)
  GROUP BY 1
), stats AS MATERIALIZED ({stats_sql('counts')}),
ratio AS MATERIALIZED ({ratio_sql('stats')}),
scored AS (
  SELECT url, CAST(floor(CAST(sum(micro) AS DOUBLE) / (1000.0e0 * count(*))) AS BIGINT) AS score
  FROM held JOIN ratio USING (w) GROUP BY url
), judged AS (SELECT * FROM ruled JOIN scored USING (url)),
histogram AS (
  SELECT score, coalesce(sum(pages) FILTER (by_rule = 'allow'), 0) AS yes, coalesce(sum(pages) FILTER (by_rule = 'block'), 0) AS no
  FROM judged WHERE by_rule IS NOT NULL AND {calibrates} GROUP BY score
), cut AS ({CUT_SQL.format(histogram='histogram')})
SELECT page_id, host, path, rule,
  coalesce(by_rule, CASE WHEN score >= coalesce((SELECT max(score) FROM cut), 0) THEN 'allow' ELSE 'block' END) AS verdict,
  score
FROM src JOIN judged USING (url)
"""


ORACLE = _oracle()
