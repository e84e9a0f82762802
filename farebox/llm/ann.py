"""Approximate nearest neighbours by adaptive dimension scan (operator 6).

Nearness is the largest inner product. One more component, which brings every
candidate to the largest norm, turns it into the smallest Euclidean distance.
Vectors are rotated at random and dealt to the lists of their nearest
centroids; a query visits the lists nearest to it. There, rotated vectors are
compared column block by column block: after d of D columns, a candidate is
abandoned if its partial distance, scaled by D / d, is beyond the query's
limit by a factor (1 + eps / sqrt(d)): the hypothesis that the whole distance
is within the limit is then rejected. The limit is the query's k-th distance
to the rows of a bounded pilot in its lists; these rows themselves are never
abandoned, so a query finds k. What is left is scored exactly on the original
vectors in double precision.

Centroids, rotation, pilot and the number of visited lists are fitted on at
most ``SAMPLE_ROWS`` rows: the fewest lists that hold ``RECALL`` of the
sample's own true neighbours. Every row is indexed. Lists are cut into blocks
of about ``BLOCK_ROWS``, so a hot list is many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import prepare, shuffle_width, stored
from .vectors import best_of, grouped, matrix, merge_lists, of_all_dimensions, pack, usable

SAMPLE_ROWS = 16384
PILOT_ROWS = 8192
TUNE_QUERIES = 256
RECALL = 0.95
EPS = 2.1
COLUMNS = 16
BLOCK_ROWS = 2048
QUERY_ROWS = 512
STEP = 1 << 16    # pairs scored at a time
SPARSE = 0.2      # share of live pairs below which pairs are followed one by one


@dataclass
class Index:
    rotation: np.ndarray    # (D + 1, D + 1)
    norm2: float            # largest squared norm of any row
    centroids: np.ndarray   # (lists, D + 1), rotated
    probes: int
    pilot_ids: np.ndarray
    pilot: np.ndarray       # (pilot rows, D + 1), rotated
    pilot_list: np.ndarray  # the lists they are in

    def candidates(self, x: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.norm2 - (x * x).sum(axis=1), 0.0))
        return np.column_stack([x, lift]) @ self.rotation

    def queries(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.zeros(len(x))]) @ self.rotation


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)


def fit(ids: np.ndarray, x: np.ndarray, total: int, norm2: float, k: int, seed: int = 0) -> Index:
    """From a sample ``x`` of ``total`` rows."""
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((x.shape[1] + 1,) * 2))[0]
    index = Index(rotation, norm2, np.zeros((0, x.shape[1] + 1)), 1, ids[:PILOT_ROWS],
                  np.zeros((0, x.shape[1] + 1)), np.zeros(0, dtype=np.int64))
    y = index.candidates(x)
    index.pilot = y[:PILOT_ROWS]
    lists = max(1, min(int(np.sqrt(total)) // 2, len(x) // 32))
    index.centroids = y[rng.permutation(len(y))[:lists]]
    for _ in range(8 if lists > 1 else 0):
        near = distances(y, index.centroids).argmin(axis=1)
        count = np.bincount(near, minlength=lists)
        sums = np.zeros_like(index.centroids)
        np.add.at(sums, near, y)
        full = count > 0
        index.centroids[full] = sums[full] / count[full, None]
    index.pilot_list = distances(index.pilot, index.centroids).argmin(axis=1)
    if lists > 1:
        q = rng.permutation(len(x))[:TUNE_QUERIES]
        near = distances(y, index.centroids).argmin(axis=1)
        lifted = index.queries(x[q])
        d = distances(lifted, y)
        d[np.arange(len(q)), q] = np.inf
        true = np.argpartition(d, min(k, len(x) - 1) - 1, axis=1)[:, :min(k, len(x) - 1)]
        order = distances(lifted, index.centroids).argsort(axis=1)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(lists)[None, :], axis=1)
        held = np.bincount(np.take_along_axis(rank, near[true], axis=1).ravel(), minlength=lists)
        index.probes = int(np.searchsorted(np.cumsum(held), RECALL * held.sum())) + 1
    return index


def _assign(index: Index):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vec"))
                near = distances(index.candidates(x), index.centroids).argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near.astype(np.int64)), batch.column("id"), pack(x)],
                    ["list", "id", "vec"])
    return run


def _visit(index: Index, sizes: np.ndarray, k: int):
    """Each query once for each list that it visits: the ``probes`` nearest,
    more if these hold too few rows. ``limit`` is its k-th squared distance
    to the pilot rows of those lists."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column("id").to_numpy(), matrix(batch.column("vec"))
            for a in range(0, len(ids), QUERY_ROWS):
                own, v = ids[a:a + QUERY_ROWS], x[a:a + QUERY_ROWS]
                y = index.queries(v)
                order = distances(y, index.centroids).argsort(axis=1, kind="stable")
                held = np.cumsum(sizes[order], axis=1)
                probes = np.maximum(index.probes, (held < k + 1).sum(axis=1) + 1)
                visited = np.arange(order.shape[1])[None, :] < probes[:, None]
                goes = np.zeros_like(visited)
                np.put_along_axis(goes, order, visited, axis=1)
                d = distances(y, index.pilot)
                d[(own[:, None] == index.pilot_ids[None, :]) | ~goes[:, index.pilot_list]] = np.inf
                limit = np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] >= k else np.full(len(y), np.inf)
                row, place = np.nonzero(visited)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(order[row, place].astype(np.int64)), pa.array(own[row]), pack(v[row]),
                     pa.array(limit[row])], ["list", "id", "vec", "limit"])
    return run


def scan(index: Index, qid: np.ndarray, q: np.ndarray, limit: np.ndarray, cid: np.ndarray,
         c: np.ndarray, rotated: np.ndarray, k: int):
    """(query, candidate, score) of the k best of each query among ``c``."""
    y = index.queries(q)
    limit = limit * (1 + 1e-9) + 1e-12
    pilot = np.isin(cid, index.pilot_ids)
    row, col = [], []
    for some, within in ((np.flatnonzero(pilot), whole), (np.flatnonzero(~pilot), adaptive)):
        if len(some):
            r, s = within(y, rotated[some], limit, qid[:, None] != cid[some][None, :])
            row.append(r)
            col.append(some[s])
    row, col = np.concatenate(row), np.concatenate(col)
    score = np.concatenate([np.zeros(0), *((q[row[a:a + STEP]] * c[col[a:a + STEP]]).sum(axis=1)
                                           for a in range(0, len(row), STEP))])
    top = best_of(row, cid[col], score, k)
    return qid[row[top]], cid[col[top]], score[top]


def whole(y, rotated, limit, live):
    """(query, candidate) pairs within the limit."""
    return np.nonzero(live & (distances(y, rotated) <= limit[:, None]))


def adaptive(y, rotated, limit, live):
    """The same by blocks of columns; the pairs that a block's hypothesis test
    rejects are abandoned. Few live pairs are followed one by one."""
    width = y.shape[1]
    partial = np.zeros(live.shape)
    row = col = part = None
    for a in range(0, width, COLUMNS):
        b = min(a + COLUMNS, width)
        bound = limit * (b / width) * (1 + EPS / np.sqrt(b)) ** 2 if b < width else limit
        if row is None:
            partial += distances(y[:, a:b], rotated[:, a:b])
            live &= partial <= bound[:, None]
            if live.mean() < SPARSE or b == width:
                row, col = np.nonzero(live)
                part = partial[row, col]
        else:
            diff = y[row, a:b] - rotated[col, a:b]
            part = part + (diff * diff).sum(axis=1)
            ok = part <= bound[row]
            row, col, part = row[ok], col[ok], part[ok]
    return row, col


def _scans(index: Index, k: int, dim: int):
    def run(batches):
        now, parts, own = None, [], None
        for key, role, span, ids, vec, batch in grouped(batches, ["block"], dim):
            if key != now:
                now, parts, own = key, [], None
            if role == 0:
                parts.append((ids, vec))
                continue
            if not parts:
                continue
            if own is None:
                cid, c = (np.concatenate(x) for x in zip(*parts))
                own = cid, c, index.candidates(c)
            limit = batch.column("limit").to_numpy(zero_copy_only=False)[span]
            for a in range(0, len(ids), QUERY_ROWS):
                z = slice(a, a + QUERY_ROWS)
                q, hit, score = scan(index, ids[z], vec[z], limit[z], *own, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(np.full(len(q), key[0])), pa.array(hit), pa.array(score)],
                    ["query_id", "part", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, every: int, k: int, id_col: str = "vec_id",
            vec_col: str = "embedding", block_rows: int = BLOCK_ROWS, seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    ``every``, the ``k`` nearest other rows found, nearest first, ties to the
    smaller id; all if there are fewer. ``score`` is the inner product of the
    original vectors in double precision.

    Rows without an id, and vectors that are null, empty, zero or hold null or
    non-finite components take no part. Vectors of different dimensions are
    searched apart, each among its own. A repeated row counts once. Rows of
    one id are never each other's candidates.
    """
    spark = vectors.sparkSession
    prepare(spark)
    lists = [_nearest_of(rows, dim, every, k, block_rows, seed) for rows, dim in usable(vectors, id_col, vec_col, zero=False)]
    if not lists:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return of_all_dimensions(lists, k)


def _nearest_of(rows: DataFrame, dim: int, every: int, k: int, block_rows: int, seed: int) -> DataFrame:
    """The search among vectors of one dimension."""
    spark = rows.sparkSession
    rows = stored(rows, "vectors")
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    total, norm2 = rows.agg(F.count("*"), F.max(norm)).first()
    sample = rows.orderBy(F.xxhash64("id"), "id", "vec").limit(SAMPLE_ROWS).toArrow()
    index = fit(sample["id"].to_numpy(), matrix(sample["vec"].combine_chunks()), total,
                float(norm2), k, seed)
    listed = stored(rows.mapInArrow(_assign(index), "list long, id long, vec binary"), "lists")
    sizes = np.zeros(len(index.centroids), dtype=np.int64)
    for r in listed.groupBy("list").count().collect():  # one row per centroid
        sizes[r["list"]] = r["count"]
    count = -(-sizes // block_rows)
    blocks = spark.createDataFrame(
        [(i, int(first), int(n)) for i, (first, n) in enumerate(zip(np.cumsum(count) - count, count)) if n],
        "list long, first long, blocks long")
    candidates = listed.join(F.broadcast(blocks), "list").select(
        (F.col("first") + F.pmod(F.xxhash64("id"), "blocks")).alias("block"), F.lit(0).alias("role"),
        "id", "vec", F.lit(None).cast("double").alias("limit"))
    queries = (rows.filter(F.pmod("id", F.lit(every)) == 0)
               .mapInArrow(_visit(index, sizes, k), "list long, id long, vec binary, limit double")
               .join(F.broadcast(blocks), "list")
               .select(F.explode(F.sequence("first", F.col("first") + F.col("blocks") - 1)).alias("block"),
                       F.lit(1).alias("role"), "id", "vec", "limit"))
    hits = (candidates.union(queries).repartition(shuffle_width(spark), "block")
            .sortWithinPartitions("block", "role")
            .mapInArrow(_scans(index, k, dim), "query_id long, part long, vec_id long, score double"))
    return merge_lists(hits, int(count.sum()), k)
