import os

import pytest

SF = "/root/testdata/sf0.001"
WORDS = "the quick brown fox jumps over a lazy dog and runs far away from home today".split()


def prose(seed: int, n: int) -> str:
    """``n`` words that depend on ``seed``; windows hardly repeat."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"{WORDS[x % len(WORDS)]}{(x >> 8) % 97}")
    return " ".join(out)


PASSAGE = prose(99, 60)

# Null ids and texts, empty and blank texts, copies, repeated rows, one id
# with two texts, a passage within a document and across documents, a long text.
EDGE_ROWS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two"), (6, "One  TWO"),
    (7, prose(1, 80)), (8, prose(1, 80)), (8, prose(1, 80)), (9, prose(2, 30) + " " + PASSAGE),
    (10, PASSAGE + " " + prose(3, 40)), (11, PASSAGE + "\n" + PASSAGE), (None, prose(4, 50)),
    (None, prose(4, 50) + " end"), (None, None), (12, prose(5, 40)), (12, prose(6, 40) + " " + PASSAGE),
    (13, "same " * 300), (14, prose(7, 30_000)), (15, "é ñ 日本語 \x1f▁ 🙂 don't"),
    (-3, prose(1, 80) + " tail"),
]
EXTRA = ("score", "version", "n_words", "blob", "fp", "key", "spans", "c0", "place", "ids")


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(*r, *("x" for _ in EXTRA)) for r in EDGE_ROWS]
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark, edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(os.path.join(SF, "documents.parquet"))


def rows_of(df, *columns):
    return [(r[columns[0]], r[columns[1]]) for r in df.select(*columns).collect()]
