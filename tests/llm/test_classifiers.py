"""Operators 3 and 7: held-out accuracy, edge rows, missing labels."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from farebox.llm import quality, toxicity

from .conftest import EDGE_ROWS

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"),
            spark.read.parquet(f"{SF}/labels.parquet"))


def held_out(scores, labels, column):
    rows = (scores.join(labels, "doc_id").filter(~quality.in_training())
            .select("score", F.col(column).alias("y")).collect())
    s, y = np.array([r["score"] for r in rows]), np.array([r["y"] for r in rows])
    assert ((0 <= s) & (s <= 1)).all()
    auc = np.mean([np.mean((s[y == 0] < v) + 0.5 * (s[y == 0] == v)) for v in s[y == 1]])
    return s, y, auc


def test_quality_on_held_out_documents(tables):
    docs, labels = tables
    s, y, auc = held_out(quality.score(docs, quality.fit(docs, labels)), labels, "quality")
    assert auc > 0.99 and ((s >= quality.CUT) == (y == 1)).mean() > 0.98


def test_toxicity_on_held_out_documents(tables):
    docs, labels = tables
    s, y, auc = held_out(toxicity.score(docs, toxicity.fit(docs, labels)), labels, "toxic")
    assert auc > 0.95 and (s[y == 0] >= 0.5).mean() < 0.01 and (s[y == 1] >= 0.5).mean() > 0.8


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_rows_and_missing_labels(spark, edge, nothing, tables, module, column):
    _, labels = tables
    few = spark.createDataFrame([(7, 1, 0), (7, None, None), (None, 1, 1), (500, 0, 1)],
                                "doc_id long, quality int, toxic int")
    for known in (few, labels.limit(0)):
        model = module.fit(edge, known, column)
        out = module.score(edge, model)
        assert out.columns.count("score") == 1 and "version" in out.columns
        rows = out.select("doc_id", "score").collect()
        assert len(rows) == len(EDGE_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
        assert module.score(nothing, model).count() == 0
    assert module.score(nothing, module.fit(nothing, labels, column)).count() == 0


def test_labels_of_the_held_out_fold_are_not_learnt(spark, tables):
    docs, labels = tables
    seen = quality.labelled(docs, labels, "quality", 10_000)
    assert seen.filter(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0).count() == 0
    assert quality.labelled(docs, labels, "quality", 100).count() == 100


def test_score_does_not_depend_on_the_batch():
    texts = pa.array(["", None, "Some words here. And MORE!!", "a### b### c###", "same same same", "x" * 9999])
    whole = quality.feature_rows(texts)
    assert np.allclose(whole, np.concatenate([quality.feature_rows(texts.slice(i, 1)) for i in range(len(texts))]))
    lexicon = {"idiot": 5.0, "achlic*": 3.0}
    texts = pa.array(["you idiot!", "an 1d10t, u know", "achlichein du", "", None, "IDIOT " * 40])
    whole = toxicity.feature_rows(texts, lexicon)
    alone = [toxicity.feature_rows(texts.slice(i, 1), lexicon) for i in range(len(texts))]
    assert np.allclose(whole, np.concatenate(alone))
    at = toxicity.FEATURES.index
    assert whole[0][at("near_second")] == 1 and whole[1][at("obfuscated_hits")] > 0
    assert whole[2][at("weak")] > 0 and whole[5][at("strong")] == 1 and not whole[3].any()


def test_the_threshold_is_the_cut():
    model = quality.Ranking(np.array([1.0]), 2.0)
    s = model.score(np.array([[1.999999999999999], [2.0], [2.1], [-900.0], [900.0]]))
    assert (s >= quality.CUT).tolist() == [False, True, True, False, True]


def test_the_sample_is_bounded_by_ids(spark):
    """One id in most rows, with several texts, is one labelled document."""
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(400)] + [(i, "other") for i in range(100, 200)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(7, 1)] + [(i, i % 2) for i in range(100, 200)], "doc_id long, quality int")
    for rows in (2, 30, 1000):
        sample = quality.labelled(docs, labels, "quality", rows)
        assert sample.count() <= rows and sample.select("doc_id").distinct().count() == sample.count()
    assert quality.labelled(docs, labels, "quality", 1000).filter("doc_id = 7").first()["text"] == "text 0"


def test_exact_quantile(spark, monkeypatch):
    rng = np.random.default_rng(1)
    for values in (rng.standard_normal(3001), np.repeat([1.0, 2.0, 3.0], 500), np.array([5.0]), rng.integers(0, 9, 800) * 1.0):
        df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
        for share in (0.0, 0.2, 0.371, 0.5, 1.0):
            for accuracy in (1_000_000, 50):
                monkeypatch.setattr(quality, "ACCURACY", accuracy)
                assert quality.quantile(df, "v", share) == np.quantile(values, share, method="midpoint")


def test_pairwise_fit_against_plain_descent(spark, tables):
    """The weights minimise the logistic loss over preference pairs: no step of a
    plain gradient descent on the same pairs finds a lower one; and the cut is
    the quantile of all labelled scores."""
    docs, labels = tables
    docs = docs.filter("doc_id < 1500")
    model = quality.fit(docs, labels)
    rows = (docs.join(quality.training_labels(labels, "quality"), "doc_id").select("label", "text").collect())
    y = np.array([r["label"] for r in rows])
    x = quality.expand(quality.feature_rows(pa.array([r["text"] for r in rows])))
    z = x @ model.weights
    assert abs(model.threshold - np.quantile(z, (y == 0).mean(), method="midpoint")) < 1e-9
    # over all pairs, not only the ones it was fitted on: the learnt order is
    # as good as that of descent on them
    good, bad = x[y == 1], x[y == 0]
    w, pairs = np.zeros(x.shape[1]), (good[:, None, :] - bad[None, :, :]).reshape(-1, x.shape[1])
    for _ in range(300):
        w += 2.0 * (pairs / (1 + np.exp(pairs @ w))[:, None]).mean(axis=0)
    def loss(v):
        return np.log1p(np.exp(-np.clip(pairs @ v, -500, 500))).mean()
    assert loss(model.weights) <= loss(w) + 1e-3
    assert ((pairs @ model.weights) > 0).mean() >= ((pairs @ w) > 0).mean() - 1e-3


def test_margins_and_calibration_against_plain_evaluation(spark, tables):
    """Scores are those of walking each tree and interpolating the isotonic steps."""
    docs, labels = tables
    docs = docs.filter("doc_id < 3000")
    model = toxicity.fit(docs, labels)
    some = docs.filter("doc_id < 150")
    rows = some.collect()
    x = toxicity.feature_rows(pa.array([r["text"] for r in rows]), model.lexicon)

    def walk(node, v):
        while node.numDescendants():
            split = node.split()
            node = node.leftChild() if v[split.featureIndex()] <= split.threshold() else node.rightChild()
        return node.prediction()
    trees, weights = model.trees._java_obj.trees(), list(model.trees.treeWeights)
    margin = np.array([sum(w * walk(t.rootNode(), v) for t, w in zip(trees, weights)) for v in x])
    assert all(b >= a for a, b in zip(model.values, model.values[1:]))       # isotonic
    want = np.clip(np.interp(margin, model.bounds, model.values), 0, 1)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(some, model).collect()}
    assert np.allclose([got[r["doc_id"]] for r in rows], want, atol=1e-9)


def test_held_out_of_a_null_id(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,), (5,), (6,), (7,), (8,)], "doc_id long")
    got = {r["doc_id"]: r["h"] for r in df.select("doc_id", quality.held_out().alias("h")).collect()}
    assert got[None] is False and set(got.values()) == {True, False}
