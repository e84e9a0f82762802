"""Exact top-k search by tiled matrix products (operator 10).

Candidates are dealt to shards by a hash of their id: one for each
``SHARD_BYTES`` of vectors, more where the session has tasks for them. A tile is a
block of queries times a block of a shard's candidates: one matrix product,
then a partial selection of the k best of each query, cut to k over the
shard's tiles. The lists of a query are merged as a tree of bounded fan-in.
Every query goes to every shard once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import prepare, shuffle_width, stored
from .vectors import best_of, grouped, matrix, merge_lists, of_all_dimensions, pack, usable

SHARD_BYTES = 128 << 20
TILE_ROWS = 4096
QUERY_ROWS = 512
SCALE = 256
EXACT = float(1 << 53)   # integers of a smaller size are exact in double precision
LONG = (-(1 << 63) + 1, (1 << 63) - 1)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued rows as long. Doubles are exact while
    no partial sum can reach 2^53; beyond that Python integers are used, and
    a score outside the range of a long is the nearest value inside it."""
    bound = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * q.shape[1]
    if bound < EXACT:
        return (q @ c.T).astype(np.int64)
    exact, other = (np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)
                    for m in (q, c))
    return np.clip(exact @ other.T, *LONG).astype(np.int64)


def tile(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int):
    """(query, candidate, score) of the k best of each query in one tile."""
    score = products(q, c)
    rank = np.where(qid[:, None] == cid[None, :], -(1 << 63), score)
    if len(cid) > k:  # what reaches the k-th best score of its query
        least = np.partition(rank, len(cid) - k, axis=1)[:, len(cid) - k]
        row, col = np.nonzero(rank >= least[:, None])
    else:
        row, col = np.nonzero(np.ones_like(rank, dtype=bool))
    own = qid[row] == cid[col]
    row, col = row[~own], col[~own]
    top = best_of(row, cid[col], score[row, col], k)
    return qid[row[top]], cid[col[top]], score[row[top], col[top]]


def tiles(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int):
    """The same over all tiles of a shard."""
    found = [tile(qid, q, cid[a:a + TILE_ROWS], c[a:a + TILE_ROWS], k) for a in range(0, len(cid), TILE_ROWS)]
    if len(found) == 1:
        return found[0]
    query, hit, score = (np.concatenate(x) for x in zip(*found))
    top = best_of(query, hit, score, k)
    return query[top], hit[top], score[top]


def _tiles(k: int, dim: int):
    def run(batches):
        now, parts, candidates = None, [], None
        for key, role, _, ids, vec, _ in grouped(batches, ["shard"], dim):
            if key != now:
                now, parts, candidates = key, [], None
            if role == 0:
                parts.append((ids, vec))
                continue
            if not parts:
                continue
            if candidates is None:
                candidates = [np.concatenate(x) for x in zip(*parts)]
            for a in range(0, len(ids), QUERY_ROWS):
                q, c, s = tiles(ids[a:a + QUERY_ROWS], vec[a:a + QUERY_ROWS], *candidates, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(np.full(len(q), key[0], dtype=np.int64)), pa.array(c),
                     pa.array(s)], ["query_id", "part", "vec_id", "score"])
    return run


def _floors(batches):
    for batch in batches:
        if batch.num_rows:
            rows = np.floor(SCALE * matrix(batch.column("vec")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pack(rows)], ["id", "vec"])


def top_k(vectors: DataFrame, every: int, k: int, id_col: str = "vec_id",
          vec_col: str = "embedding", shard_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    ``every``, the ``k`` other rows with the largest inner product of the
    components floor(256 x), ties to the smaller id; all if there are fewer.

    Rows without an id, and vectors that are null, empty or hold null or
    non-finite components take no part. Vectors of different dimensions are
    searched apart, each among its own. A repeated row counts once. Rows of
    one id are never each other's candidates; if their vectors differ, the id
    gets one list, the best of all its rows'.
    """
    spark = vectors.sparkSession
    prepare(spark)
    lists = [_top_k_of(rows, dim, every, k, shard_rows) for rows, dim in usable(vectors, id_col, vec_col, SCALE)]
    if not lists:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return of_all_dimensions(lists, k)


def shard_number(rows: int, dim: int, width: int) -> int:
    """Shards of ``SHARD_BYTES``; of a smaller table as many as there are tasks,
    as long as each has a tile."""
    return max(1, -(-rows * dim * 8 // SHARD_BYTES), min(width, -(-rows // TILE_ROWS)))


def _top_k_of(rows: DataFrame, dim: int, every: int, k: int, shard_rows: int | None) -> DataFrame:
    """The search among vectors of one dimension."""
    width = shuffle_width(rows.sparkSession)
    rows = stored(rows.mapInArrow(_floors, "id long, vec binary"), "vectors")
    n = rows.count()
    shards = -(-n // shard_rows) if shard_rows else shard_number(n, dim, width)
    candidates = rows.select(F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"),
                             F.lit(0).alias("role"), "id", "vec")
    every_shard = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    queries = rows.filter(F.pmod("id", F.lit(every)) == 0).select(
        every_shard.alias("shard"), F.lit(1).alias("role"), "id", "vec")
    hits = (candidates.union(queries).repartition(max(shards, width), "shard")
            .sortWithinPartitions("shard", "role")
            .mapInArrow(_tiles(k, dim), "query_id long, part long, vec_id long, score long"))
    return merge_lists(hits, shards, k)
