"""Multi-party chat formatting by perspective rotation, as DataFrame operations.

Each participant of a conversation gets a rendering in which that speaker is
the assistant, every other participant is a named user and context speakers
(``system``) stay as they are.  The masks are the code-point ranges to train
on: the assistant's words and the marker that ends the turn.

A conversation is cut into parts of ``PART_TURNS`` rows by their running
position in it, whatever its turn numbers are, so a part is one bounded row;
a conversation's parts in order make up its whole rendering.  Positions come
from a window over the conversation, or, where it holds more than one of
``HOT`` parts of all rows (so of at most ``HOT`` conversations), from running
sums over ranges of its rows.  Only the distinct (conversation, speaker)
pairs, pre-aggregated, are joined in.

Cases: a null conversation id is one conversation; a null speaker is named
``unknown``; a null turn number comes first; a null or empty text
renders as an empty turn; turns of the same number are ordered by speaker
and text and repeated rows are rendered as often as they occur; a
conversation of context turns only has no participant and so no row; the
marker opening ``<|`` inside names or texts is written ``< |``; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlake.llm.common import OWN
from emberlake.llm.ordered import running

PART_TURNS = 1024
HOT = 4096
CONTEXT_SPEAKERS = ("system",)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
NO_TURN = -(1 << 62)


def _escaped(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def positions(rows: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """``rows`` (conversation, no, speaker, body) with ``at``, the number of
    rows of the conversation before it by (no, speaker, body): those of most
    conversations, dealt by conversation, and those of the large ones."""
    conv, order = OWN + "conv", ["no", "speaker", "body"]
    sizes = rows.groupBy(conv).agg(F.count("*").alias("n"))
    total = rows.count()
    # At most ``hot`` rows, as each has more than a ``hot``-th of the total.
    large = F.broadcast(sizes.filter(F.col("n") * hot > F.greatest(F.lit(total), F.lit(PART_TURNS * hot)))
                        .select(F.col(conv).alias(OWN + "of"), "n"))
    same = F.col(conv).eqNullSafe(F.col(OWN + "of"))
    inside = Window.partitionBy(conv).orderBy(*order)
    cold = rows.join(large, same, "left_anti").withColumn("at", (F.row_number().over(inside) - 1).cast("long"))
    starts = large.select(OWN + "of", F.coalesce(F.sum("n").over(
        Window.orderBy(OWN + "of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(OWN + "start"))
    # The row id splits ranges of equal rows, which are interchangeable.
    found = rows.join(large, same, "left_semi").withColumn(OWN + "row", F.monotonically_increasing_id())
    run = running(found, [F.col(c) for c in (conv, *order, OWN + "row")], {OWN + "before": F.lit(1)}, "chat-hot")
    warm = run.join(F.broadcast(starts), same).select(*rows.columns, (F.col(OWN + "before") - F.col(OWN + "start")).alias("at"))
    return cold, warm


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        speaker_col: str = "role", text_col: str = "text", part_turns: int = PART_TURNS,
                        context: tuple[str, ...] = CONTEXT_SPEAKERS, hot: int = HOT) -> DataFrame:
    """One row per conversation, part and participant: the rendering, its
    masks (array of start, stop) and counts."""
    speaker = F.regexp_replace(F.coalesce(F.col(speaker_col).cast("string"), F.lit("unknown")), r"[\x00-\x20]+", " ")
    rows = turns.select(
        F.col(conv_col).alias(OWN + "conv"), F.coalesce(F.col(turn_col).cast("long"), F.lit(NO_TURN)).alias("no"),
        _escaped(speaker).alias("speaker"),
        _escaped(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("body"))
    number = F.floor(F.col("at") / part_turns).cast("long").alias("part")
    # Gathered apart, so that the first needs no further exchange.
    cold, warm = (df.groupBy(OWN + "conv", number).agg(F.array_sort(F.collect_list(F.struct("no", "speaker", "body"))).alias("turns"))
                  for df in positions(rows, hot))
    parts = cold.unionAll(warm)
    heard = (rows.filter(~F.col("speaker").isin(*context)) if context else rows)
    people = heard.select(F.col(OWN + "conv").alias(OWN + "of"), F.col("speaker").alias("perspective")).distinct()
    views = parts.join(people, F.col(OWN + "conv").eqNullSafe(F.col(OWN + "of")))
    me = F.col("perspective")

    def segment(t: Column) -> Column:
        role = (F.when(t.speaker == me, F.lit("assistant"))
                .when(t.speaker.isin(*context) if context else F.lit(False), t.speaker)
                .otherwise(F.concat(F.lit("user name="), t.speaker)))
        return F.struct(F.concat(F.lit(OPEN), role, F.lit("\n")).alias("head"),
                        F.concat(t.body, F.lit(CLOSE)).alias("rest"), (t.speaker == me).alias("mine"))

    views = views.withColumn("segments", F.transform("turns", segment))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("masks"))

    def step(acc: Column, s: Column) -> Column:
        begin = acc.at + F.length(s.head)
        stop = begin + F.length(s.rest)
        mask = F.array(F.struct(begin.alias("start"), stop.alias("stop")))
        return F.struct((stop + 1).alias("at"), F.when(s.mine, F.concat(acc.masks, mask)).otherwise(acc.masks).alias("masks"))

    return views.select(
        F.col(OWN + "conv").alias(conv_col), "part", "perspective",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s.head, s.rest, F.lit("\n"))), "").alias("rendered"),
        F.aggregate("segments", start, step, lambda acc: acc.masks).alias("masks"))


def chat_report(turns: DataFrame) -> DataFrame:
    """The renderings with their masks written as ``start:stop`` pairs."""
    out = rotate_perspectives(turns)
    pairs = F.transform("masks", lambda m: F.concat_ws(":", m.start.cast("string"), m.stop.cast("string")))
    return out.withColumn("masks", F.array_join(pairs, ","))


_CONTEXT = "(" + ", ".join(f"'{c}'" for c in CONTEXT_SPEAKERS) + ")"
ORACLE = f"""
WITH t AS (
  SELECT conv_id, coalesce(turn, {NO_TURN}) AS no,
    replace(regexp_replace(coalesce(role, 'unknown'), '[\\x00-\\x20]+', ' ', 'g'), '<|', '< |') AS speaker,
    replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY no, speaker, body) - 1) // {PART_TURNS} AS part FROM t
), people AS (SELECT DISTINCT conv_id AS of_conv, speaker AS perspective FROM r WHERE speaker NOT IN {_CONTEXT}),
seg AS (
  SELECT conv_id, part, perspective, no, speaker, body,
    row_number() OVER (PARTITION BY conv_id, part, perspective ORDER BY no, speaker, body) AS i,
    '{OPEN}' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker IN {_CONTEXT} THEN speaker
      ELSE 'user name=' || speaker END || chr(10) AS head, body || '{CLOSE}' AS rest
  FROM r JOIN people ON conv_id IS NOT DISTINCT FROM of_conv
), placed AS (
  SELECT *, sum(length(head) + length(rest) + 1) OVER (PARTITION BY conv_id, part, perspective ORDER BY i) AS after FROM seg
)
SELECT conv_id, part, perspective, count(*) AS n_turns, string_agg(head || rest || chr(10), '' ORDER BY i) AS rendered,
  coalesce(string_agg(CAST(after - 1 - length(rest) AS BIGINT) || ':' || CAST(after - 1 AS BIGINT), ',' ORDER BY i)
    FILTER (speaker = perspective), '') AS masks
FROM placed GROUP BY conv_id, part, perspective
"""
