"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a row of slots, each of ``block_words`` words of one source.  Every
source has a whole number of slots for its target; laid side by side, the
sources' slots are the cumulative weights, and a van der Corput sequence
(the bit reversals of 0, 1, 2, ...) visits them, so that any stretch of the
mix holds the sources near their weights.  The slots of a source are ranked,
its documents are shuffled by a digest of id and text, laid end to end (twice
over, as a target may be up to twice the source) and cut into equal blocks,
and the block of a number goes to the slot of that rank.  The last block of a source ends
at its target, so the words taken are the target rounded to a whole word.

Targets: the sources, by code point and null last, have the ``weights`` in
turn and share ``share`` times all words; a target stops at ``repeats`` times its
source's words, and what is above is shared out again by weight.  That is
one level for all sources that are not full: the greatest of (all words to give
- caps of the fuller sources) / (weights of the others) over the sources in
order of cap by weight.

Scale: orders and running sums are range-partitioned (``ordered.running``), so
a hot source is spread over tasks; repeated rows are one row with a count until
they are dealt out; the table of sources is broadcast only when counted and small;
the driver gets three totals.  The answer depends on the rows alone, not on
files, partitions or the number of executors.

Cases: a null or empty text has size 0 and is taken 0 times; a null source is
one source, the last; a null id is an id like any other; repeated rows are mixed
row by row; no words at all give targets of 0; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import OWN, SPACE_CLASS, staged, text_or_empty
from emberlake.llm.ordered import counted_out, running
from emberlake.operators.sizing import broadcast_if_small

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 1024
WORD = f"[^{SPACE_CLASS}]+"


def _digest(id_col: str, text_col: str) -> Column:
    return F.md5(F.concat(text_or_empty(id_col), F.lit(":"), text_or_empty(text_col)).cast("binary"))


def sized_groups(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row for equal documents: source, id, size in words, digest, copies."""
    rows = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"),
                       F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
                       _digest(id_col, text_col).alias("digest"))
    return staged(rows.groupBy("source", "id", "size", "digest").agg(F.count("*").alias("copies")), "mix-groups")


def source_targets(groups: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   repeats: int = REPEATS) -> DataFrame:
    """One row per source: number, words, words of the sources before, weight and target."""
    sources = staged(groups.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")), "mix-sources")
    by_name = [F.col("source").isNull(), F.col("source")]
    numbered = running(sources, by_name, {"no": F.lit(1), "before": F.col("source_size")}, "mix-numbered")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("no") % len(weights)).cast("int"))
    weighed = staged(numbered.withColumn("weight", weight.cast("long")), "mix-weighed")
    words, weighs = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    cap = F.col("source_size") * repeats
    filled = running(weighed, [cap / F.col("weight"), F.col("no")], {"caps": cap, "lighter": F.col("weight")}, "mix-filled")
    level = (F.lit(share * (words or 0)) - F.col("caps")) / (F.lit(weighs or 0) - F.col("lighter"))
    highest = filled.agg(F.max(level)).first()[0] or 0.0
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(highest)))
    return staged(weighed.withColumn("target", target).withColumn("quota", F.round("target").cast("long")), "mix-targets")


def reversed_bits(c: Column, bits: int) -> Column:
    """The ``bits`` low bits of a whole number in reverse order."""
    return F.conv(F.reverse(F.lpad(F.bin(c), max(1, bits), "0")), 2, 10).cast("long")


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per slot of the mix: slot, source number and the slot's rank in its source."""
    counted = targets.withColumn("n_slots", F.ceil(F.col("quota") / block_words).cast("long"))
    laid = running(counted, [F.col("no")], {"first_point": F.col("n_slots")}, "mix-laid")
    n = counted.agg(F.sum("n_slots")).first()[0] or 0
    points = counted_out(laid.select("no", "first_point", "n_slots"), F.col("n_slots"), "j")
    visit = reversed_bits(F.col("first_point") + F.col("j"), max(0, n - 1).bit_length())
    visited = staged(points.select("no", "first_point", visit.alias("visit")), "mix-points")
    slots = running(visited, [F.col("visit")], {"slot": F.lit(1)}, "mix-slots")
    ranked = running(slots, [F.col("no"), F.col("visit")], {"at": F.lit(1)}, "mix-ranked")
    return ranked.select("slot", "no", (F.col("at") - F.col("first_point")).alias("rank"))


def placed_documents(groups: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per document: a number of its own, its source's columns and
    its place in its source's words."""
    order = [F.col("source").isNull(), F.col("source"), F.col("digest"), F.col("id"), F.col("size")]
    at = running(groups, order, {"at": F.col("size") * F.col("copies"), "row": F.col("copies")}, "mix-order")
    known = broadcast_if_small(targets.withColumnRenamed("source", OWN + "of"))
    at = at.join(known, F.col("source").eqNullSafe(F.col(OWN + "of")))
    rows = counted_out(at, F.col("copies"), "k")
    place = F.col("at") - F.col("before") + F.col("k") * F.col("size")
    return staged(rows.select("id", "source", "digest", "size", "source_size", "target", "quota", "no",
                              (F.col("row") + F.col("k")).alias("row"), place.alias("place")), "mix-rows")


def mixed_pieces(rows: DataFrame, slots: DataFrame, block_words: int = BLOCK_WORDS, repeats: int = REPEATS) -> DataFrame:
    """One row per stretch of a document in a slot: row, id, digest, slot, its
    place there and the document's words [first_word, end_word)."""
    again = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    passes = rows.filter("size > 0").withColumn("pass", again).withColumn(
        "start", F.col("place") + F.col("pass") * F.col("source_size")).filter("start < quota").withColumn(
        "stop", F.least(F.col("start") + F.col("size"), F.col("quota")))
    width = F.lit(block_words).cast("long")
    number = lambda c: F.floor(c / width).cast("long")
    cut = passes.withColumn("rank", F.explode(F.sequence(number(F.col("start")), number(F.col("stop") - 1))))
    low, high = F.greatest("start", F.col("rank") * width), F.least("stop", (F.col("rank") + 1) * width)
    return cut.join(slots, ["no", "rank"]).select(
        "row", "id", "source", "digest", "slot", (low - F.col("rank") * width).alias("slot_word"),
        (low - F.col("start")).alias("first_word"), (high - F.col("start")).alias("end_word"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
                  block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """The documents' rows with their targets, and the pieces of the mix."""
    groups = sized_groups(docs, id_col, text_col, source_col)
    targets = source_targets(groups, weights, share, repeats)
    rows = placed_documents(groups, targets)
    return rows, mixed_pieces(rows, schedule(targets, block_words), block_words, repeats)


def slot_texts(docs: DataFrame, pieces: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: one row per slot with its words, joined by spaces."""
    texts = docs.select(F.col(id_col).alias("id"), _digest(id_col, text_col).alias("digest"),
                        text_or_empty(text_col).alias("t")).dropDuplicates(["digest", "id"])
    both = pieces.alias("p").join(texts.alias("d"), (F.col("p.digest") == F.col("d.digest")) & F.col("p.id").eqNullSafe(F.col("d.id")))
    words = F.slice(F.regexp_extract_all("t", F.lit(WORD), F.lit(0)), (F.col("first_word") + 1).cast("int"),
                    (F.col("end_word") - F.col("first_word")).cast("int"))
    cut = both.select("slot", "slot_word", "source", F.array_join(words, " ").alias("t"))
    ordered = F.array_sort(F.collect_list(F.struct("slot_word", "t")))  # at most block_words pieces
    return cut.groupBy("slot").agg(F.first("source").alias("source"), F.array_join(ordered["t"], " ").alias("text"))


def mix_report(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: its size, its source's size and target, the words
    that the mix takes of it, and the pieces and first slot that hold them."""
    rows, pieces = mix_documents(docs, block_words=block_words)
    taken = pieces.groupBy("row").agg(F.sum(F.col("end_word") - F.col("first_word")).alias("taken"),
                                      F.count("*").alias("n_pieces"), F.min("slot").alias("first_slot"))
    zero = F.lit(0).cast("long")
    return rows.join(taken, "row", "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", zero).alias("taken"),
        F.coalesce("n_pieces", zero).alias("n_pieces"), "first_slot")


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1 AS no
  FROM d GROUP BY source
), w AS (
  SELECT *, [{', '.join(map(str, WEIGHTS))}][CAST(no % {len(WEIGHTS)} AS INT) + 1] AS weight FROM s
), f AS (
  SELECT *, sum(weight) OVER () AS weighs, sum(source_size) OVER () AS words,
    coalesce(sum({REPEATS} * source_size) OVER o, 0) AS caps, coalesce(sum(weight) OVER o, 0) AS lighter
  FROM w WINDOW o AS (ORDER BY CAST({REPEATS} * source_size AS DOUBLE) / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT *, max((CAST({SHARE} * CAST(words AS DOUBLE) AS DOUBLE) - CAST(caps AS DOUBLE)) / CAST(weighs - lighter AS DOUBLE)) OVER () AS level
  FROM f
), t AS (
  SELECT *, least(CAST({REPEATS} * source_size AS DOUBLE), weight * level) AS target FROM g
), q AS (
  SELECT *, CAST(round(target) AS BIGINT) AS quota, CAST(ceil(round(target) / {BLOCK_WORDS}) AS BIGINT) AS n_slots FROM t
), c AS (
  SELECT *, CAST(sum(n_slots) OVER (ORDER BY no) AS BIGINT) AS after, CAST(sum(n_slots) OVER () AS BIGINT) AS n FROM q
), p AS (
  SELECT no, n, unnest(range(after - n_slots, after)) AS point FROM c
), v AS (
  SELECT no, CAST('0b' || reverse(lpad(bin(point), CAST(length(bin(n - 1)) AS INT), '0')) AS BIGINT) AS visit FROM p
), slots AS (
  SELECT no, row_number() OVER (ORDER BY visit) - 1 AS slot, row_number() OVER (PARTITION BY no ORDER BY visit) - 1 AS rank FROM v
), r AS (
  SELECT d.*, q.no, q.source_size, q.target, q.quota, row_number() OVER () AS row,
    sum(size) OVER (PARTITION BY q.no ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS place
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
), a AS (
  SELECT row, no, place + i * source_size AS start, least(place + i * source_size + size, quota) AS stop
  FROM r, range({REPEATS}) AS x(i) WHERE size > 0 AND place + i * source_size < quota
), b AS (
  SELECT row, no, start, stop, unnest(range(CAST(start // {BLOCK_WORDS} AS BIGINT), CAST((stop - 1) // {BLOCK_WORDS} AS BIGINT) + 1)) AS rank
  FROM a
), taken AS (
  SELECT row, CAST(sum(least(stop, (rank + 1) * {BLOCK_WORDS}) - greatest(start, rank * {BLOCK_WORDS})) AS BIGINT) AS taken,
    count(*) AS n_pieces, min(slot) AS first_slot
  FROM b JOIN slots USING (no, rank) GROUP BY row
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, coalesce(n_pieces, 0) AS n_pieces, first_slot
FROM r LEFT JOIN taken USING (row)
"""
