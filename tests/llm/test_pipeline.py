"""The pipeline stage by stage, against what each stage promises."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from farebox.llm import quality, secret_ledger, simhash

from .conftest import EDGE_ROWS, EXTRA, SF
from .test_duplicates import brute_components, brute_removed
from .test_text import check_packing


def rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


@pytest.fixture(scope="module")
def stages(spark, documents):
    """Each stage's input, and the last one's output."""
    docs, out = documents.select("doc_id", "text", "lang", "source", "n_chars"), []
    for _, stage in pipeline.STAGES:
        out.append(docs)
        docs = stage(spark, docs, SF).cache()
    return [*out, docs]


def test_stage_order():
    assert [f for _, f in pipeline.STAGES] == [
        pipeline.keep_quality, pipeline.drop_near_duplicates, pipeline.drop_repeated_passages,
        pipeline.redact_secrets, pipeline.pack]


def test_quality_stage(spark, stages):
    model = quality.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    kept = quality.score(stages[0], model).filter(F.col("score") >= quality.CUT).select("doc_id")
    assert {r[0] for r in kept.collect()} == {r["doc_id"] for r in stages[1].collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").join(stages[1], "doc_id")
    assert labels.filter("quality = 0").count() == 0 and stages[1].columns == stages[0].columns


def test_near_duplicate_stage(stages):
    groups = {}
    for (i, t), (_, _, c) in zip(rows(stages[1]), brute_components(rows(stages[1]))):
        groups.setdefault(c, []).append((i, t))
    assert rows(stages[2]) == sorted(min(g) for g in groups.values())


def test_passage_stage(stages):
    want = []
    for (i, t), (_, n, gone, kept) in zip(rows(stages[2]), brute_removed(rows(stages[2]))):
        if gone == 0 or gone < n:
            want.append((i, t if gone == 0 else kept))
    assert rows(stages[3]) == want
    assert stages[3].filter(F.length("text") != F.col("n_chars")).count() == 0


def test_secret_stage(stages):
    before, after = dict(rows(stages[3])), dict(rows(stages[4]))
    assert set(before) == set(after)
    for i, text in before.items():
        found = [s for f in (secret_ledger.assign, secret_ledger.access, secret_ledger.hexadecimal) for s in f(text)]
        assert (after[i] != text) == bool(found)
        assert not secret_ledger.access(after[i]) and not secret_ledger.hexadecimal(after[i])


def test_packing_stage(stages):
    check_packing(stages[5].collect(), rows(stages[4]))


def test_run_gives_the_stages_result(spark, stages):
    key = ("doc_id", "start", "length", "ids_crc32")
    out = pipeline.run(spark, SF)
    assert {tuple(r[k] for k in key) for r in out.collect()} == {tuple(r[k] for k in key) for r in stages[5].collect()}


def test_stages_on_edge_rows(spark, edge, nothing):
    for docs in (edge, nothing):
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            docs = out.cache()
            if name == "near_duplicates" and docs.count():
                kept = rows(docs)
                assert len(set(kept)) == len(kept)
        pipeline.pack(spark, docs, SF).collect()


def test_near_duplicates_without_ids(spark):
    same = "a b c d e f g h"
    df = spark.createDataFrame([(None, same, 1), (None, same, 2), (5, same + " i j", 3), (None, None, 4), (None, "", 5),
                                (7, "quite another text of some words", 6)], "doc_id long, text string, fp int")
    groups = {}
    for r in simhash.near_duplicates(df).collect():
        groups.setdefault(r["component"], []).append(r["doc_id"])
    out = pipeline.drop_near_duplicates(spark, df, SF)
    assert out.columns == ["doc_id", "text", "fp"] and out.count() == len(groups)
    assert len(EDGE_ROWS) and EXTRA
