"""What the two vector searches share: usable rows, packed vectors, and the
merging of per-query lists."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FAN_IN = 16
MOST_DIMENSIONS = 64


def usable(vectors: DataFrame, id_col: str, vec_col: str, scale: float = 1.0,
           zero: bool = True) -> list[tuple[DataFrame, int]]:
    """(id long, vec array<double>) of each dimension that occurs, smallest
    first: rows with an id and a vector whose components times ``scale`` are
    finite numbers; without ``zero``, only vectors with a component other than
    0. Rows that repeat an id and vector count once. Vectors of different
    dimensions have no inner product, so each dimension is a search of its
    own; more than ``MOST_DIMENSIONS`` of them are an error."""
    vec = F.col(vec_col).cast("array<double>")
    inf = float("inf")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(
        "id is not null and size(vec) > 0")
    rows = rows.filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x)
                                & (F.abs(x * F.lit(scale)) < inf)))
    if not zero:
        rows = rows.filter(F.exists("vec", lambda x: x != 0.0))
    found = rows.select(F.size("vec").alias("dim")).distinct().limit(MOST_DIMENSIONS + 1).collect()
    if len(found) > MOST_DIMENSIONS:
        raise ValueError(f"vectors of more than {MOST_DIMENSIONS} dimensions: not one collection")
    return [(rows.filter(F.size("vec") == dim).dropDuplicates(["id", "vec"]), dim)
            for dim in sorted(r["dim"] for r in found)]


def of_all_dimensions(lists: list[DataFrame], k: int) -> DataFrame:
    """The lists (query_id, rank, vec_id, score) of several dimensions as one: an
    id that has vectors of more than one keeps the k best of all its lists."""
    if len(lists) == 1:
        return lists[0]
    every = functools.reduce(DataFrame.unionByName, lists)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list<double> column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def pack(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values of 8 bytes a component."""
    rows = np.ascontiguousarray(rows, dtype="<f8")
    step = rows.shape[1] * 8 if rows.ndim == 2 else 0
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [
        None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int64) * step),
        pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def unpack(column: pa.Array, dim: int) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)
    a, b = offsets[column.offset], offsets[column.offset + len(column)]
    return np.frombuffer(column.buffers()[2], dtype="<f8", count=(b - a) // 8,
                         offset=a).reshape(-1, dim)


def grouped(batches, names: list[str], dim: int):
    """Of batches sorted by ``names`` and role: (key, role, ids, vectors) of
    each stretch of equal key and role that a batch holds."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in names], axis=1)
        role = batch.column("role").to_numpy()
        ids, vec = batch.column("id").to_numpy(), unpack(batch.column("vec"), dim)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (role[1:] != role[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(role)]):
            yield tuple(keys[a].tolist()), int(role[a]), slice(a, b), ids[a:b], vec[a:b], batch


def best_of(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` best hits of each query: largest score, ties to the
    smaller id."""
    by = np.lexsort((ids, -score, query))
    q = query[by]
    first = np.ones(len(q), dtype=bool)
    first[1:] = q[1:] != q[:-1]
    place = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    return by[place < k]


def merge_lists(hits: DataFrame, parts: int, k: int) -> DataFrame:
    """From (query_id, part, vec_id, score), at most k to a query and part:
    (query_id, rank, vec_id, score). A tree: each step joins the lists of
    ``FAN_IN`` parts of a query and keeps k."""
    worst = -F.col("score").cast("decimal(20,0)") if dict(hits.dtypes)["score"] == "bigint" else -F.col("score")
    hit = F.struct(worst.alias("worst"), "vec_id", "score")
    lists = hits.select("query_id", "part", F.array(hit).alias("hits"))
    while True:
        lists = (lists.groupBy("query_id", F.floor(F.col("part") / FAN_IN).alias("part"))
                 .agg(F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k).alias("hits")))
        parts = -(-parts // FAN_IN)
        if parts <= 1:
            break
    return (lists.select("query_id", F.posexplode("hits").alias("pos", "hit"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    F.col("hit.score").alias("score")))
