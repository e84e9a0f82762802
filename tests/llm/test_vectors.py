"""Operators 6 and 10 against brute force."""

import numpy as np
import pytest

from farebox.llm import ann, topk
from farebox.llm.vectors import best_of, pack, unpack

SF = "/root/testdata/sf0.1"
NAN, INF = float("nan"), float("inf")


def brute(ids, x, every, k, same=None):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), s[j]) for j in order]
    return out


def lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        got = out.setdefault(r["query_id"], [])
        got.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got)
    return out


@pytest.fixture(scope="module")
def embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    return df, np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)


def test_top_k_is_exact(embeddings):
    df, ids, x = embeddings
    want = brute(ids, np.floor(256 * x), 50, 5)
    for rows in (64, 4096):
        assert lists(topk.top_k(df, 50, 5, shard_rows=rows)) == {
            q: [(i, int(s)) for i, s in hits] for q, hits in want.items()}


def test_nearest_recall_and_exact_scores(embeddings):
    df, ids, x = embeddings
    want = brute(ids, x, 20, 20)
    got = lists(ann.nearest(df, 20, 20, block_rows=300))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    place = {int(i): n for n, i in enumerate(ids)}
    for q, hits in got.items():
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
        assert all(abs(x[place[q]] @ x[place[i]] - s) < 1e-12 and i != q for i, s in hits)
    assert np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 20 for q in want]) >= 0.9


def test_nearest_without_unit_length_and_with_hot_vector(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 16)) * rng.gamma(2.0, 1.0, (3000, 1))
    x[1000:2000] = x[0]
    ids = np.arange(3000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    want, got = brute(ids, x, 100, 20), lists(ann.nearest(df, 100, 20, block_rows=200))
    assert all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q]}) / 20 for q in want]) >= 0.9


EDGE = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, None, 1), (3, [], 1), (4, [1.0, None], 1), (5, [NAN, 1.0], 1),
        (6, [INF, 1.0], 1), (7, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (8, [0.0, 0.0], 1), (9, [1.0, 2.0], 2),
        (9, [1.0, 2.0], 2), (100, [-1.0, 0.5], 3), (50, [1.0, 2.0], 3)]


def test_edge_vectors(spark):
    df = spark.createDataFrame(EDGE, "vec_id long, embedding array<double>, part int")
    got = lists(topk.top_k(df, 50, 5))
    assert set(got) == {0, 50, 100}
    assert [i for i, _ in got[0]] == [1, 9, 50, 8, 100] and [i for i, _ in got[50]] == [0, 1, 9, 8, 100]
    assert got[100] == [(8, 0), (0, 0), (1, 0), (9, 0), (50, 0)] or [s for _, s in got[100]] == [0] * 5
    near = lists(ann.nearest(df, 50, 20))
    assert [i for i, _ in near[0]] == [1, 9, 50, 100] and 8 not in {i for v in near.values() for i, _ in v}
    for empty in (df.limit(0), df.filter("vec_id = 2")):
        assert topk.top_k(empty, 50, 5).count() == 0 and ann.nearest(empty, 50, 20).count() == 0


def test_products_beyond_doubles():
    big = float(1 << 40)
    q, c = np.array([[big, 1.0]]), np.array([[big, 1.0], [1.0, 3.0]])
    assert topk.products(q, c).tolist() == [[topk.LONG[1], (1 << 40) + 3]]
    q = c = np.array([[float(1 << 28), 1.0]])
    assert topk.products(q, c).tolist() == [[(1 << 56) + 1]]


def test_floor_of_negative_components(spark):
    df = spark.createDataFrame([(0, [-0.001, 0.5]), (1, [0.3, -0.3])], "vec_id long, embedding array<double>")
    assert lists(topk.top_k(df, 50, 5)) == {0: [(1, -1 * 76 + 128 * -77)]}


def test_best_of_and_packing():
    q, i, s = np.array([1, 1, 1, 0]), np.array([5, 4, 3, 9]), np.array([2, 2, 7, 1])
    assert [(int(q[j]), int(i[j])) for j in best_of(q, i, s, 2)] == [(0, 9), (1, 3), (1, 4)]
    m = np.arange(6.0).reshape(3, 2)
    assert (unpack(pack(m).slice(1, 2), 2) == m[1:]).all()


def test_no_vector_is_dropped_for_its_dimension(spark):
    """One vector of one component at the smallest id, before 199 good ones: each
    dimension is searched by itself."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((199, 8))
    ids = np.arange(1, 200)
    rows = [(0, [0.5])] + [(int(i), v.tolist()) for i, v in zip(ids, x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert lists(topk.top_k(df, 50, 5)) == {
        q: [(i, int(s)) for i, s in hits] for q, hits in brute(ids, np.floor(256 * x), 50, 5).items()}
    near = lists(ann.nearest(df, 20, 20))
    assert set(near) == {20, 40, 60, 80, 100, 120, 140, 160, 180} and all(len(v) == 20 for v in near.values())
    # an id in two dimensions keeps the best of both lists; a second short vector is found
    more = df.union(spark.createDataFrame([(50, [2.0]), (51, [3.0])], df.schema))
    got = lists(topk.top_k(more, 50, 5))
    assert got[0] == [(51, 128 * 768), (50, 128 * 512)] and (51, 512 * 768) in got[50]
    assert len(got[50]) == 5 and got[50] == sorted(got[50], key=lambda h: (-h[1], h[0]))
    many = spark.createDataFrame([(i, [1.0] * (i + 1)) for i in range(70)], df.schema)
    for search in (topk.top_k, ann.nearest):
        with pytest.raises(ValueError, match="dimensions"):
            search(many, 50, 5)


def test_tiles_of_a_shard_keep_the_best(spark, monkeypatch, embeddings):
    df, ids, x = embeddings
    monkeypatch.setattr(topk, "TILE_ROWS", 128)
    got = topk.tiles(ids[:40], np.floor(256 * x[:40]), ids, np.floor(256 * x), 5)
    want = brute(ids, np.floor(256 * x), 1, 5)
    hits = {}
    for q, c, s in zip(*got):
        hits.setdefault(int(q), []).append((int(c), s))
    assert hits == {int(i): [(c, int(s)) for c, s in want[int(i)]] for i in ids[:40]}


def test_shards_grow_with_bytes():
    assert topk.shard_number(1000, 64, 200) == 1 and topk.shard_number(100_000, 64, 200) == 25
    assert topk.shard_number(10 ** 9, 64, 200) == -(-10 ** 9 * 64 * 8 // topk.SHARD_BYTES) < 4000
