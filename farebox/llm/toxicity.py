"""Toxicity by gradient-boosted trees over dense features (operator 7).

Features: densities of lexicon words, their nearness to words of the second
person, capitals, punctuation, and rates of obfuscated spelling. The lexicon
(whole words and word beginnings) is learnt from one part of the labelled
sample by log-odds, the trees from a second part and the isotonic
calibration, which turns the trees' margin into a probability, from a third,
so that no part judges what it has taught.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import features as X
from . import words as W
from .quality import labelled
from .runtime import prepare, stored

SAMPLE_ROWS = 20_000     # labelled documents to learn from, at the most
LEXICON = 400            # entries, at the most
LEAST_DOCS = 4           # labelled 1 that hold an entry
LEAST_ODDS = 2.0         # natural logarithm
STRONG_ODDS = 3.5
STEM = 6                 # letters of a word's beginning
NEAR = 5                 # words
TREES, DEPTH = 20, 3
PARTS = (0.5, 0.35)      # of the sample: lexicon, trees; the rest calibrates
CHUNK_BYTES = 8 << 20

# Fixed value: words of the second person.
SECOND = frozenset("""you your yours yourself ya u ur du dich dir dein deine deiner euch euer tu toi te
    vous ton ta tes votre vos tú ti usted ustedes tus""".split())
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿…«»“”„‘’"
# Fixed value: letters that digits and signs stand for.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i",
                      **{c: None for c in "*._-#%&+~^'"}})

FEATURES = ("strong", "weak", "odds", "most_odds", "hits", "obfuscated_hits", "near_second", "second",
            "upper", "capital_words", "shout", "stop", "symbol", "obfuscated", "log_words")


def units(word: str) -> list[str]:
    """A word's own entry and that of its beginning."""
    return [word, word[:STEM] + "*"] if len(word) > STEM else [word]


def plain(word: bytes) -> str:
    return word.decode("utf-8", "replace").lower().strip(MARKS)


def _lexicon_counts(batches):
    for batch in batches:
        column = batch.column("text")
        label = batch.column("label").to_numpy()
        for a, n in W.chunks(column, CHUNK_BYTES):
            w = W.encode(column.slice(a, n))
            size = np.diff(w.bounds)
            pairs = np.unique((w.codes.astype(np.int64) << 32) | np.repeat(np.arange(n), size))
            vocab = w.vocab.to_pylist()
            seen: dict[str, set[int]] = {}
            for pair in pairs.tolist():
                for u in units(plain(vocab[pair >> 32])):
                    seen.setdefault(u, set()).add(pair & 0xFFFFFFFF)
            toxic = set(np.flatnonzero(label[a:a + n] == 1).tolist())
            ones = [len(d & toxic) for d in seen.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen.keys(), pa.string()), pa.array(ones, pa.int64()),
                 pa.array([len(d) - k for d, k in zip(seen.values(), ones)], pa.int64())],
                ["unit", "ones", "zeros"])


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Entry -> log-odds, of (label, text)."""
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    odds = (F.log((F.col("ones") + 0.5) / (n.get(1, 0) + 1.0))
            - F.log((F.col("zeros") + 0.5) / (n.get(0, 0) + 1.0)))
    rows = (sample.select("label", "text")
            .mapInArrow(_lexicon_counts, "unit string, ones long, zeros long")
            .groupBy("unit").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
            .withColumn("odds", odds)
            .filter((F.col("ones") >= LEAST_DOCS) & (F.col("odds") >= LEAST_ODDS) & (F.length("unit") > 1))
            .orderBy(F.desc(F.col("odds") * F.sqrt("ones")), "unit").limit(LEXICON).collect())
    return {r["unit"]: r["odds"] for r in rows}


def feature_rows(texts: pa.Array, lexicon: dict[str, float]) -> np.ndarray:
    """(texts, FEATURES); an empty text has zeros."""
    counts, _ = X.byte_counts(texts)
    w = W.encode(texts)
    size = len(w.vocab)
    odds, hidden = np.zeros(size), np.zeros(size, dtype=bool)
    second, capital, odd = (np.zeros(size, dtype=bool) for _ in range(3))
    for i, word in enumerate(w.vocab.to_pylist()):
        p = plain(word)
        found = max((lexicon.get(u, 0.0) for u in units(p)), default=0.0)
        if not p.isalpha() and len(p) > 2 and any(map(str.isalpha, p)):
            odd[i] = True
            if not found:
                q = word.decode("utf-8", "replace").lower().strip(",;:?()\"").translate(LEET)
                found = max(lexicon.get(u, 0.0) for u in units(q)) if q.isalpha() else 0.0
                hidden[i] = found > 0
        odds[i] = found
        second[i] = p in SECOND
        capital[i] = len(word) > 2 and word.isupper()
    n = np.diff(w.bounds).astype(np.float64)
    some = np.maximum(n, 1)

    def share(flags: np.ndarray) -> np.ndarray:
        return X.per_text(flags[w.codes].astype(np.float64), w.bounds) / some

    by_word = odds[w.codes]
    hit = np.flatnonzero(by_word > 0)
    here = np.arange(len(w.codes))
    you = second[w.codes]
    before = np.maximum.accumulate(np.where(you, here, -1)) if len(here) else here
    after = np.minimum.accumulate(np.where(you, here, len(here))[::-1])[::-1] if len(here) else here
    doc = np.searchsorted(w.bounds, hit, side="right") - 1
    near = (((hit - before[hit] <= NEAR) & (before[hit] >= w.bounds[doc]))
            | ((after[hit] - hit <= NEAR) & (after[hit] < w.bounds[doc + 1])))
    near_hits = np.bincount(doc, near, minlength=len(n))
    most = np.zeros(len(n))
    np.maximum.at(most, doc, by_word[hit])
    hits = np.bincount(doc, minlength=len(n)).astype(np.float64)
    by = dict(zip(X.CLASSES, counts.T))
    columns = {
        "strong": share(odds >= STRONG_ODDS), "weak": share((odds > 0) & (odds < STRONG_ODDS)),
        "odds": X.per_text(by_word, w.bounds) / some, "most_odds": most, "hits": np.log1p(hits),
        "obfuscated_hits": share(hidden), "near_second": near_hits / np.maximum(hits, 1),
        "second": share(second),
        "upper": by["upper"] / np.maximum(by["lower"] + by["upper"] + by["high"], 1),
        "capital_words": share(capital), "shout": by["shout"] / some, "stop": by["stop"] / some,
        "symbol": by["symbol"] / some, "obfuscated": share(odd), "log_words": np.log1p(n),
    }
    return np.nan_to_num(np.column_stack([columns[k] for k in FEATURES]))


def _features(lexicon: dict[str, float], names: list[str]):
    """The text is the last column; ``x`` takes its place."""
    def run(batches):
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a, n in W.chunks(column, CHUNK_BYTES):
                x = feature_rows(column.slice(a, n), lexicon)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, n) for i in range(batch.num_columns - 1)),
                     pa.array(list(x), pa.list_(pa.float64()))], [*names, "x"])
    return run


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    bounds: list[float]        # the isotonic function's steps ..
    values: list[float]        # .. and its values there


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """From at most ``rows`` labelled documents outside the held-out fold. A
    sample without both labels in each part gives the share of label 1 as every score."""
    sample = stored(labelled(docs, labels, label_col, rows)
                    .withColumn("u", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(1000)) / 1000), "sample")
    a, b = PARTS
    lexicon = learn_lexicon(sample.filter(F.col("u") < a))
    x = stored(sample.filter(F.col("u") >= a).select("label", "u", "text").mapInArrow(
        _features(lexicon, ["label", "u"]), "label int, u double, x array<double>"), "features")
    teach, judge = x.filter(F.col("u") < a + b), x.filter(F.col("u") >= a + b)
    for part in (teach, judge):
        if part.select("label").distinct().count() < 2:
            share = sample.agg(F.avg("label")).first()[0]
            return Model(lexicon, None, [0.0], [float(share or 0.0)])
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH,
                        maxBins=64, stepSize=0.2, seed=7)
    trees = gbt.fit(teach.select("label", array_to_vector("x").alias("features")))
    margin = vector_to_array(F.col("rawPrediction"))[1]
    judged = trees.transform(judge.select("label", array_to_vector("x").alias("features"))).select(
        F.col("label").cast("double").alias("label"), margin.alias("margin"))
    steps = IsotonicRegression(featuresCol="margin", labelCol="label").fit(judged)
    return Model(lexicon, trees, list(steps.boundaries), list(steps.predictions))


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all but a former ``score``) of each row and
    ``score``, the
    calibrated probability of label 1; a null text scores as the empty one.
    The text is the only input."""
    prepare(docs.sparkSession)
    keep = docs.drop("score").columns if keep is None else keep
    names = [f"c{i}" for i in range(len(keep))]
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)), F.col(f"`{text_col}`").alias("t"))
    if model.trees is None:
        return rows.withColumn("score", F.lit(model.values[0])).drop("t").toDF(*keep, "score")
    schema = T.StructType([*rows.drop("t").schema.fields, T.StructField("x", T.ArrayType(T.DoubleType()))])
    x = rows.mapInArrow(_features(model.lexicon, names), schema).withColumn("features", array_to_vector("x"))
    margin = vector_to_array(F.col("rawPrediction"))[1]
    out = model.trees.transform(x).select(*names, margin.alias("margin"))
    return out.select(*names, calibrated(model).alias("score")).toDF(*keep, "score")


def calibrated(model: Model):
    """The isotonic function of ``margin``: linear between its steps."""
    at, to = model.bounds, model.values
    out = F.when(F.col("margin") <= at[0], F.lit(to[0]))
    for (p, q), (u, v) in zip(zip(at, at[1:]), zip(to, to[1:])):
        if q > p:
            out = out.when(F.col("margin") <= q, F.lit(u) + (F.col("margin") - p) * ((v - u) / (q - p)))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), out.otherwise(F.lit(to[-1]))))
