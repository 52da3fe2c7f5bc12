"""Toxicity scores: boosted trees over dense features, isotonic calibration.

Every document's whole text is reduced to a few dense features in one scan:
densities of a fixed and of a learned insult lexicon, the share of insults
with a second-person word close before or after, capitals, punctuation runs,
and obfuscation rates (digits or signs within words, letters spaced out, and
insults that show only once such signs are undone).  Gradient-boosted trees
are trained on the labelled rows of the learning folds, and an isotonic
regression, fitted on a fold of them that the trees did not see, turns their
margin into a probability.

The labelled rows used are bounded by ``MAX_TRAINING_ROWS`` (least hashes of
the id first); their ids fit a broadcast for that reason.  Scoring, like the
features, covers every row and needs no shuffle.

Labels are learned only from rows with ``crc32(id) % 5 != 0``; labels,
language, source and id are never inputs of a score.

Cases: a null text counts as empty and gets the score of all-zero features;
a null id is in no fold, so not held out, and never learned from; several
labels of one id count as toxic if any is; equal texts get equal scores; with
fewer than ``MIN_TRAINING_ROWS`` labelled rows, or one class only, every row
gets the share of toxic labels (0 without labels); an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlake.llm.common import OWN, staged, text_or_empty, with_code
from emberlake.llm.text import chunks, text_bytes, words

FOLDS = 5
MAX_TRAINING_ROWS = 40_000
MIN_TRAINING_ROWS = 40
CALIBRATION_SHARE = 4  # one learning row in so many calibrates
LEARNED_WORDS = 200
MIN_WORD_DOCS = 5
NEAR_WORDS = 6

# Insults and second-person words of the four languages.
INSULTS = (
    "idiot", "moron", "stupid", "pathetic", "worthless", "loser", "clown", "trash", "scum", "disgusting",
    "dumb", "fool", "jerk", "freak", "garbage", "imbecile",
    "dumm", "depp", "trottel", "arschloch", "abschaum", "versager",
    "stupide", "imbécile", "crétin", "ordure", "minable", "débile",
    "estúpido", "imbécil", "basura", "inútil", "asqueroso", "payaso",
)
SECOND_PERSON = ("you", "your", "yours", "u", "ur", "du", "dich", "dir", "dein", "tu", "toi", "te", "vous", "ti", "usted")
LEET_FROM, LEET_TO = "0134578@$!", "oieastbasi"
FEATURES = ("insults", "learned", "near_you", "you", "capitals", "capital_runs", "marks", "mark_runs",
            "odd_in_words", "spaced_letters", "hidden_insults", "any_insult", "any_learned")

_LEET = np.arange(256, dtype=np.uint8)
for _a, _b in zip(LEET_FROM, LEET_TO, strict=True):
    _LEET[ord(_a)] = ord(_b)
_ODD = np.zeros(256, dtype=bool)
_ODD[[ord(c) for c in "0123456789@$!*"]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


class Lexicon:
    """A set of words, looked up by their hashes."""

    def __init__(self, entries):
        raw, offsets = text_bytes(pa.array(sorted(entries), pa.string()))
        self.hashes = np.unique(words(raw, offsets).hashes)
        self.low = np.zeros(1 << 16, dtype=bool)
        self.low[self.hashes & np.uint64(0xFFFF)] = True

    def among(self, hashes: np.ndarray) -> np.ndarray:
        out = self.low[hashes & np.uint64(0xFFFF)]
        i = np.flatnonzero(out)
        out[i] = np.isin(hashes[i], self.hashes)
        return out


def _starts(x: np.ndarray, n: int, same: np.ndarray | None = None) -> np.ndarray:
    """Where runs of at least ``n`` true values start; a run stays within
    equal values of ``same``."""
    def joined(k: int) -> np.ndarray:
        y = np.zeros_like(x)
        m = max(0, len(x) - k)
        y[:m] = x[k:] if same is None else x[k:] & (same[k:] == same[:m])
        return y

    out = x.copy()
    for k in range(1, n):
        out &= joined(k)
    before = np.zeros_like(x)
    before[1:] = x[:-1] if same is None else x[:-1] & (same[1:] == same[:-1])
    return out & ~before


def dense_features(raw: np.ndarray, offsets: np.ndarray, insults: Lexicon, learned: Lexicon, you: Lexicon) -> np.ndarray:
    """One row of ``FEATURES`` for each text that ``offsets`` cut from ``raw``."""
    def by_row(x: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(x)])
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(np.float64)

    def per_row(x: np.ndarray) -> np.ndarray:
        return np.bincount(w.rows, weights=x, minlength=len(offsets) - 1)

    w = words(raw, offsets)
    hit, taught, second = (lexicon.among(w.hashes) for lexicon in (insults, learned, you))
    first = np.cumsum(w.counts) - w.counts
    at = np.flatnonzero(hit)
    seen = np.concatenate([[0], np.cumsum(second)])
    row = w.rows[at]
    near = np.zeros(len(hit))
    near[at] = seen[np.minimum(at + NEAR_WORDS + 1, first[row] + w.counts[row])] > seen[np.maximum(at - NEAR_WORDS, first[row])]
    upper, mark = (raw >= 65) & (raw <= 90), (raw == ord("!")) | (raw == ord("?"))
    letter = _LETTER[raw]
    odd = _ODD[raw]
    odd[1:] &= letter[:-1]
    odd[:1] = False
    odd[:-1] &= letter[1:]
    odd[-1:] = False
    odd_rows = by_row(odd)
    hidden = np.zeros(len(offsets) - 1)
    if odd_rows.any():
        plain = words(_LEET[raw], offsets)
        undone = np.bincount(plain.rows, weights=insults.among(plain.hashes), minlength=len(hidden))
        hidden = np.where(odd_rows > 0, np.maximum(0, undone - per_row(hit)), 0)
    n = np.maximum(1, w.counts)
    counts = [per_row(hit), per_row(taught), per_row(near), per_row(second), by_row(upper), by_row(_starts(upper, 3)),
              by_row(mark), by_row(_starts(mark, 2)), odd_rows, per_row(_starts(w.lengths == 1, 4, w.rows)), hidden]
    return np.stack([*[c / n for c in counts], np.minimum(counts[0], 3), np.minimum(counts[1], 3)], axis=1)


def with_features(texts: DataFrame, learned: list[str]) -> DataFrame:
    """``texts``, whose last column is the text, with the features (array)
    in its place."""
    with_code(texts.sparkSession)
    kept = texts.schema.fields[:-1]
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in kept], "f array<double>"])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicons = Lexicon(INSULTS), Lexicon(learned), Lexicon(SECOND_PERSON)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(batch.num_columns - 1))
            rows = [dense_features(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], *lexicons)
                    for a, b in chunks(offsets)]
            flat = np.concatenate([np.zeros((0, len(FEATURES))), *rows]).ravel()
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[f.name for f in kept] + ["f"])

    return texts.mapInArrow(describe, schema).withColumn("features", array_to_vector("f")).drop("f")


def fold_of(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def training_labels(labels: DataFrame, id_col: str, label_col: str, max_rows: int) -> DataFrame:
    """(id, label) of the learning folds, at most ``max_rows``."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold_of(id_col) != 0))
    one = known.groupBy(F.col(id_col).alias(OWN + "id")).agg(F.max((F.col(label_col) > 0).cast("double")).alias("label"))
    return one.orderBy(F.xxhash64(OWN + "id"), OWN + "id").limit(max_rows)


def learned_lexicon(texts: DataFrame, n_words: int = LEARNED_WORDS, min_docs: int = MIN_WORD_DOCS) -> list[str]:
    """Words with the highest one-sided z-score of the log odds of a toxic
    document, from (t, label); at most ``n_words``."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("t"), F.lit(r"\p{L}{3,30}"), F.lit(0)))
    seen = texts.select("label", F.explode(words).alias("w")).groupBy("w").agg(
        F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).filter(F.col("a") + F.col("b") >= min_docs)
    totals = texts.agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).first()
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    z = (F.log(a / (totals.a + 1 - F.col("a"))) - F.log(b / (totals.b + 1 - F.col("b")))) / F.sqrt(1 / a + 1 / b)
    return [r.w for r in seen.withColumn("z", z).filter("z > 3").orderBy(F.desc("z"), "w").limit(n_words).collect()]


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    picked = staged(training_labels(labels, id_col, label_col, max_rows), "tox-labels")
    source = docs.select(F.col(id_col).alias(OWN + "id"), F.col(text_col).alias("text"))
    texts = staged(source.join(F.broadcast(picked), OWN + "id").select(
        OWN + "id", "label", text_or_empty("text").alias("t")), "tox-training")
    stats = texts.agg(F.count("*").alias("n"), F.coalesce(F.avg("label"), F.lit(0.0)).alias("share")).first()
    held = F.coalesce(fold_of(OWN + "id") == 0, F.lit(False)).alias("held_out")
    if stats.n < MIN_TRAINING_ROWS or stats.share in (0.0, 1.0):
        score = F.lit(float(stats.share))
        return source.select(F.col(OWN + "id").alias(id_col), held, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
    lexicon = learned_lexicon(texts)
    calibrates = F.pmod(F.xxhash64(OWN + "id", F.lit(3)), F.lit(CALIBRATION_SHARE)) == 0
    train = staged(with_features(texts.select("label", calibrates.alias("calibrates"), "t"), lexicon), "tox-features")
    trees = GBTClassifier(labelCol="label", maxIter=20, maxDepth=3, maxBins=32, stepSize=0.2, seed=7).fit(
        train.filter("NOT calibrates"))

    def raw(df: DataFrame) -> DataFrame:
        return trees.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])

    calibration = IsotonicRegression(featuresCol="margin", labelCol="label").fit(
        raw(train.filter("calibrates")).select("margin", "label"))
    scored = with_features(source.select(OWN + "id", text_or_empty("text").alias("t")), lexicon)
    scored = calibration.setPredictionCol("p").transform(raw(scored).select(OWN + "id", "margin"))
    score = F.least(F.greatest(F.col("p"), F.lit(0.0)), F.lit(1.0))
    return scored.select(F.col(OWN + "id").alias(id_col), held, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
