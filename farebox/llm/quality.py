"""Quality classifier by Bradley-Terry pairwise ranking (operator 3).

A document's score is a linear function of dense text features. It is learnt
from preference pairs, one document labelled 1 and one labelled 0: the
probability that the first is preferred is the logistic function of the difference of
their scores, so the fit is a logistic regression without intercept on
feature differences. The scores' quantile at the share of label 0 is the
threshold; the reported score is the logistic function of the distance from
it, shifted so that the threshold is 0.3.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import features as X
from . import words as W
from .runtime import prepare, stored

SAMPLE_ROWS = 20_000     # labelled documents to learn from, at the most
PAIRS_EACH = 4           # partners of a document of the rarer label
LEARN_TASKS = 8          # of a step of the descent
CUT = 0.3
FOLDS = 5
CHUNK_BYTES = 8 << 20
ACCURACY = 1_000_000     # of the approximate quantiles that enclose the exact one

FEATURES = ("log_words", "word_length", "distinct", "commonest", "runs", "upper", "digit", "stop",
            "shout", "symbol", "high", "line", "marked", "tiny", "short", "very_short")


def feature_rows(texts: pa.Array) -> np.ndarray:
    """(texts, FEATURES): rates and shares between 0 and about 1; an empty text
    has zeros but for the two flags of short texts."""
    counts, size = X.byte_counts(texts)
    w = W.encode(texts)
    n = np.diff(w.bounds).astype(np.float64)
    some = np.maximum(n, 1)
    length = X.word_lengths(w)
    distinct, commonest = X.distinct_share(w)
    again = np.zeros(len(w.codes))
    again[1:] = w.codes[1:] == w.codes[:-1]
    inner = w.bounds[:-1]
    again[inner[inner < len(again)]] = 0
    # words that end in two symbols or shouts, as junk appended to words does
    tails = np.array([len(v) >= 2 and not v[-2:].isalnum() and v.isascii() and v[-1:] == v[-2:-1]
                      for v in w.vocab.to_pylist()], dtype=np.float64)
    by = dict(zip(X.CLASSES, counts.T))
    letters = np.maximum(by["lower"] + by["upper"] + by["high"], 1)
    bytes_ = np.maximum(size, 1)
    columns = {
        "log_words": np.log1p(n) / 10,
        "word_length": np.minimum(X.per_text(length, w.bounds) / some / 10, 3),
        "distinct": distinct / np.sqrt(some) / 10,
        "commonest": commonest,
        "runs": X.per_text(again, w.bounds) / some,
        "upper": by["upper"] / letters,
        "digit": by["digit"] / bytes_,
        "stop": by["stop"] / some,
        "shout": np.minimum(by["shout"] / some, 2),
        "symbol": np.minimum(by["symbol"] / some, 3),
        "high": by["high"] / bytes_,
        "line": by["line"] / some,
        "marked": X.per_text(tails[w.codes], w.bounds) / some,
        "tiny": X.per_text((length <= 1).astype(np.float64), w.bounds) / some,
        "short": (n < 50).astype(np.float64),
        "very_short": (n < 10).astype(np.float64),
    }
    rates = np.column_stack([columns[k] for k in FEATURES])
    return np.nan_to_num(rates)


def expand(rates: np.ndarray) -> np.ndarray:
    """The features and their square roots: small rates of junk count."""
    return np.column_stack([rates, np.sqrt(np.abs(rates))])


def in_training(id_col: str = "doc_id"):
    """Rows that labels may be learnt from."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(FOLDS)) != 0


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, rows: int) -> DataFrame:
    """(doc_id, label, text) of at most ``rows`` labelled documents outside the
    held-out fold, chosen by a hash of the id. Null ids and labels take no
    part; an id with several labels has the largest, one with several texts
    the smallest of them."""
    prepare(docs.sparkSession)
    chosen = (training_labels(labels, label_col)
              .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(stored(chosen, "labelled")), "doc_id")
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")))


def training_labels(labels: DataFrame, label_col: str) -> DataFrame:
    """(doc_id, label) of all labelled ids outside the held-out fold."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & in_training())
            .groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label")))


def held_out(id_col: str = "doc_id"):
    """Rows of the held-out fold. A null id has no fold, so it is not of it (and
    not learnt from either)."""
    return F.coalesce(~in_training(id_col), F.lit(False))


def _features(batches):
    for batch in batches:
        column = batch.column("text")
        for a, n in W.chunks(column, CHUNK_BYTES):
            x = expand(feature_rows(column.slice(a, n)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).slice(a, n) for i in range(batch.num_columns - 1)),
                 pa.array(list(x), pa.list_(pa.float64()))],
                [*batch.schema.names[:-1], "x"])


@dataclass
class Ranking:
    weights: np.ndarray
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Logistic function of the distance from the threshold, ``CUT`` at it."""
        z = np.clip(x @ self.weights - self.threshold + math.log(CUT / (1 - CUT)), -700, 700)
        s = 1 / (1 + np.exp(-z))
        return np.where(x @ self.weights >= self.threshold, np.maximum(s, CUT),
                        np.minimum(s, np.nextafter(CUT, 0)))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
        rows: int = SAMPLE_ROWS) -> Ranking:
    """Weights from at most ``rows`` labelled documents, the threshold from the
    scores of all of them. Without both labels every document scores alike: at
    the threshold."""
    spark = docs.sparkSession
    sample = labelled(docs, labels, label_col, rows)
    x = stored(sample.select("doc_id", "label", "text").mapInArrow(
        _features, "doc_id long, label int, x array<double>"), "features")
    count = {r["label"]: r["n"] for r in x.groupBy("label").agg(F.count("*").alias("n")).collect()}
    width = 2 * len(FEATURES)
    if not count.get(0) or not count.get(1):
        return Ranking(np.zeros(width), 0.0)
    # Pairs: the i-th document of the rarer label meets PAIRS_EACH of the other.
    rare = 0 if count[0] <= count[1] else 1
    other = count[1 - rare]
    place = (x.withColumn("side", F.col("label") == rare)
             .withColumn("i", F.row_number().over(
                 _by_hash()) - 1))
    few = place.filter("side").select("i", F.col("x").alias("a"), F.explode(
        F.sequence(F.lit(0), F.lit(PAIRS_EACH - 1))).alias("k"))
    few = few.withColumn("j", F.pmod(F.col("i").cast("long") * PAIRS_EACH + F.col("k"), F.lit(other)))
    many = place.filter("not side").select(F.col("i").cast("long").alias("j"), F.col("x").alias("b"))
    sign = 1.0 if rare == 1 else -1.0
    diff = F.zip_with("a", "b", lambda p, q: (p - q) * F.lit(sign))
    # Each pair in both orders. A sample's pairs are few, so a step of the descent is
    # LEARN_TASKS tasks, however many partitions the session shuffles into.
    pairs = stored(few.join(many, "j").select(diff.alias("d")), "pairs").coalesce(LEARN_TASKS)
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("d"), F.lit(1.0).alias("label")),
        F.struct(F.transform("d", lambda v: -v).alias("d"), F.lit(0.0).alias("label")))))
    model = LogisticRegression(fitIntercept=False, regParam=1e-4, maxIter=100).fit(
        both.select(array_to_vector("d").alias("features"), "label"))
    weights = np.array(model.coefficients.toArray())
    # The cut: the quantile of the scores of all labelled documents outside the
    # fold, sampled or not. Scores are narrow, so the texts are not shuffled.
    scores = docs.select("doc_id", "text").mapInArrow(_values(weights), "doc_id long, value double")
    known = stored(scores.join(training_labels(labels, label_col), "doc_id").select("label", "value"), "scores")
    zeros, both = known.agg(F.count_if(F.col("label") == 0), F.count("*")).first()
    return Ranking(weights, quantile(known, "value", zeros / both))


def _values(weights: np.ndarray):
    def run(batches):
        for batch in batches:
            column = batch.column("text")
            for a, n in W.chunks(column, CHUNK_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, n), pa.array(expand(feature_rows(column.slice(a, n))) @ weights)],
                    ["doc_id", "value"])
    return run


def quantile(rows: DataFrame, column: str, share: float) -> float:
    """The exact quantile of a column, the midpoint of its two neighbours: two
    approximate quantiles enclose it, and only the values between them, about
    four in ``ACCURACY``, are counted and collected."""
    n = rows.agg(F.count(column)).first()[0]
    margin = 2 / ACCURACY + 2 / n
    low, high = rows.agg(*(F.percentile_approx(column, min(max(x, 0.0), 1.0), ACCURACY)
                           for x in (share - margin, share + margin))).first()
    at = rows.agg(F.count_if(F.col(column) < low)).first()[0]
    near = rows.filter(F.col(column).between(low, high)).groupBy(column).count().orderBy(column).collect()
    place = share * (n - 1)
    ends = []
    for k in (math.floor(place), math.ceil(place)):
        upto = at
        for r in near:
            upto += r["count"]
            if k < upto:
                ends.append(r[column])
                break
    return float(sum(ends) / 2)


def _by_hash():
    from pyspark.sql import Window

    return Window.partitionBy("side").orderBy(F.xxhash64("doc_id"), "doc_id")


def _score(model: Ranking):
    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a, n in W.chunks(column, CHUNK_BYTES):
                s = model.score(expand(feature_rows(column.slice(a, n))))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, n) for i in range(batch.num_columns)), pa.array(s)],
                    [f"c{i}" for i in range(batch.num_columns + 1)])
    return run


def score(docs: DataFrame, model: Ranking, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all but a former ``score``) of each row and
    ``score``, from 0 to
    1; a null text scores as the empty one. The text is the only input."""
    prepare(docs.sparkSession)
    keep = docs.drop("score").columns if keep is None else keep
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)),
                       F.col(f"`{text_col}`").alias(f"c{len(keep)}"))
    schema = T.StructType([*rows.schema.fields, T.StructField(f"c{len(keep) + 1}", T.DoubleType())])
    out = rows.mapInArrow(_score(model), schema).drop(f"c{len(keep)}")
    return out.toDF(*keep, "score")
