"""Line-first quality rules, as Spark SQL expressions only.

Each line is judged alone by three rules; failing lines are removed and a
document that loses too much of its text that way is rejected, as is one
that fails the base rules (too few words, too much repetition).

Punctuation rule: a line of fewer than ``SHORT_LINE_WORDS`` words without a
closing mark, or one in which runs of ``!``/``?`` or loose symbols are
frequent.  Navigation rule: separators between most words.  Boilerplate
rule: licence, copyright, cookie and sign-up phrases.

Cases: a null text counts as empty and an empty text has no words, so both
fail the base rules; blank lines are neutral; equal rows are judged alike;
an empty table gives an empty result; extra input columns are kept by
``clean_documents`` and ignored by ``quality_report``.

Word windows are compared by 64-bit hashes of 64-bit word hashes within one
document, so two different windows are taken for equal with a probability
below 1e-9 for a document of 100,000 words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import OWN, SPACE_CLASS, any_case

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW_WORDS = 8
SHORT_LINE_WORDS = 6
MIN_KEPT_PCT = 50

WORD = f"[^{SPACE_CLASS}]+"
SYMBOLS = r"[#*$%&|<>]"
SHOUT = r"[!?][!?]"
SEPARATORS = r"[|»›•]"
CLOSED = r"[.!?:;,…\"'”»)\]][\x20\x09-\x0D]*$"
# Phrases of lines that carry no content of their own.
BOILERPLATE_PHRASES = (
    "all rights reserved", "licensed under", "this work is licensed", "released under the",
    "copyright ", "privacy policy", "cookie policy", "terms of use", "terms of service",
    "lorem ipsum", "enable javascript", "subscribe to our", "click here", "sign up for",
)
BOILERPLATE = "|".join(any_case(p) for p in BOILERPLATE_PHRASES)


def _sql(pattern: str) -> str:
    """A raw SQL string literal."""
    return "r'" + pattern.replace("'", r"\x27") + "'"


def line_fails(line: str) -> str:
    """SQL predicate: ``line`` (an SQL expression) has words and fails a rule."""
    words = f"regexp_count({line}, {_sql(WORD)})"
    return (
        f"({words} > 0 AND ("
        f"({words} < {SHORT_LINE_WORDS} AND NOT {line} RLIKE {_sql(CLOSED)})"
        f" OR regexp_count({line}, {_sql(SHOUT)}) * 5 > {words}"
        f" OR regexp_count({line}, {_sql(SYMBOLS)}) * 2 > {words}"
        f" OR regexp_count({line}, {_sql(SEPARATORS)}) * 3 > {words}"
        f" OR {line} RLIKE {_sql(BOILERPLATE)}))"
    )


def _repeat_words(words: str) -> str:
    """SQL: words of the array ``words`` inside windows that occur twice.

    ``transform(array(x), v -> ...)`` binds ``x`` to ``v`` once, so that it
    is not computed again for each element.
    """
    w = WINDOW_WORDS
    positions = (
        "transform(filter(s, (e, j) -> (j > 0 AND s[j - 1].k = e.k)"
        " OR (j < size(s) - 1 AND s[j + 1].k = e.k)), e -> e.p)"
    )
    covered = (
        "transform(array(sort_array(transform(g, (x, i) -> struct(x AS k, i AS p)))), s -> "
        f"transform(array(sort_array({positions})), p -> "
        "aggregate(transform(p, (x, j) -> "
        f"IF(j = size(p) - 1, {w}, least({w}, p[j + 1] - x))), 0, (a, b) -> a + b)))[0][0]"
    )
    return (
        f"IF(size({words}) <= {w}, 0, "
        f"transform(array(transform({words}, x -> xxhash64(x))), h -> "
        f"transform(array(transform(sequence(1, size(h) - {w - 1}), i -> xxhash64(slice(h, i, {w})))), g -> "
        f"IF(size(array_distinct(g)) = size(g), 0, {covered})))[0][0])"
    )


def with_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus one struct column ``__el_q`` with every measure, the
    cleaned text and the verdict."""
    space, word = f"[{SPACE_CLASS}]+", _sql(WORD)
    flat, text, words, lines = OWN + "flat", OWN + "t", OWN + "w", OWN + "l"
    df = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = df.withColumn(flat, F.trim(F.regexp_replace(text, space, " ")))
    df = df.withColumn(words, F.expr(f"filter(split({flat}, ' '), w -> w != '')"))
    df = df.withColumn(lines, F.split(text, "\n"))
    cleaned = f"array_join(filter({lines}, x -> NOT {line_fails('x')}), '\\n')"
    df = df.withColumn(OWN + "c", F.expr(cleaned))
    with_words = f"filter({lines}, x -> x RLIKE {word})"
    measures = {
        "n_words": f"CAST(size({words}) AS BIGINT)",
        "word_chars": f"CAST(length(replace({flat}, ' ', '')) AS BIGINT)",
        "n_symbols": f"CAST(regexp_count({text}, {_sql(SYMBOLS)}) AS BIGINT)",
        "n_dup_lines": f"CAST(transform(array({with_words}), v -> size(v) - size(array_distinct(v)))[0] AS BIGINT)",
        "n_repeat_words": f"CAST({_repeat_words(words)} AS BIGINT)",
        "kept_chars": f"CAST(length(regexp_replace({OWN}c, {_sql(space)}, '')) AS BIGINT)",
    }
    df = df.withColumns({OWN + k: F.expr(v) for k, v in measures.items()})
    failed = (F.col(OWN + "n_words") < MIN_WORDS) | (
        100 * F.col(OWN + "n_repeat_words") > MAX_REPEAT_PCT * F.col(OWN + "n_words"))
    enough = 100 * F.col(OWN + "kept_chars") >= MIN_KEPT_PCT * F.col(OWN + "word_chars")
    q = F.struct(*[F.col(OWN + k).alias(k) for k in measures], failed.alias("base_failed"),
                 (~failed & enough).alias("kept"), F.col(OWN + "c").alias("cleaned_text"))
    return df.select(*[F.col(f"`{c}`") for c in docs.columns], q.alias(OWN + "q"))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the measures, ``base_failed`` and ``kept``."""
    q = with_quality(docs.select(id_col, text_col), text_col)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "kept_chars"]
    return q.select(id_col, *[F.col(f"{OWN}q.{n}").alias(n) for n in names])


def clean_documents(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """Kept documents with their failing lines removed; same columns."""
    # Computed once, in a generator: a filter and a projection would each hold all the rules.
    once = with_quality(docs, text_col).withColumn(OWN + "q", F.explode(F.array(OWN + "q")))
    out = once.filter(F.col(f"{OWN}q.kept")).withColumn(text_col, F.col(f"{OWN}q.cleaned_text"))
    if chars_col and chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.length(F.col(text_col)).cast(kind))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_LINES = f"""
lines AS (
  SELECT doc_id, t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS no FROM d
), judged AS (
  SELECT doc_id, line, no, len(regexp_extract_all(line, '{WORD}')) AS nw,
    length(regexp_replace(line, '[{SPACE_CLASS}]+', '', 'g')) AS wc,
    CASE WHEN len(regexp_extract_all(line, '{WORD}')) > 0 AND (
      (len(regexp_extract_all(line, '{WORD}')) < {SHORT_LINE_WORDS}
        AND NOT regexp_matches(line, '{CLOSED.replace("'", "''")}'))
      OR len(regexp_extract_all(line, '{SHOUT}')) * 5 > len(regexp_extract_all(line, '{WORD}'))
      OR len(regexp_extract_all(line, '{SYMBOLS}')) * 2 > len(regexp_extract_all(line, '{WORD}'))
      OR len(regexp_extract_all(line, '{SEPARATORS}')) * 3 > len(regexp_extract_all(line, '{WORD}'))
      OR regexp_matches(line, '{BOILERPLATE}')) THEN 1 ELSE 0 END AS bad
  FROM lines
)"""

ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{ORACLE_LINES},
per_line AS (
  SELECT doc_id, count(*) FILTER (nw > 0) - count(DISTINCT line) FILTER (nw > 0) AS n_dup_lines,
    sum(wc) FILTER (bad = 0) AS kept_chars
  FROM judged GROUP BY doc_id
), w AS (SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS ws FROM d
), windows AS (
  SELECT doc_id, p, ws[p : p + {WINDOW_WORDS - 1}] AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW_WORDS - 2})) AS p FROM w)
), twice AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) AS c FROM windows) WHERE c > 1
), repeated AS (
  SELECT doc_id, sum(least({WINDOW_WORDS}, coalesce(nxt - p, {WINDOW_WORDS}))) AS n_repeat_words
  FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS nxt FROM twice) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '{SYMBOLS}')) AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(kept_chars, 0) AS BIGINT) AS kept_chars
  FROM w JOIN per_line USING (doc_id) LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)
    AND 100 * kept_chars >= {MIN_KEPT_PCT} * word_chars AS kept,
  kept_chars
FROM m
"""
