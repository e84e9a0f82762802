"""Ranked lexical search by dense blocked matrix products (operator 11).

Items (queries) are searched against all documents. Only terms of items can
score, so a document is reduced to the counts of those: its row of impacts.
Per block of items and tile of documents, the block's own terms are cut into
tiles of columns; weights (items x terms) times impacts (terms x documents) is
one float64 product. All factors are integers and a tile is narrow enough that
no partial sum reaches 2^53, so every product is exact and partial scores add
up as 64-bit integers. The k best of a tile are found by partial selection at
the k-th score, ties included, and cut by document id.

Documents are read, counted and scored where they lie; what is shuffled is one
list of at most k hits per item and task, and one count per term and task.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .runtime import prepare, stored

ITEM_ROWS = 64               # items of a block
TERM_COLUMNS = 1024          # terms of a tile, at the most
DOC_ROWS = 512               # documents of a tile
CHUNK_BYTES = 8 << 20
GROUP_BYTES = 32 << 20       # terms of the items that one pass over the documents serves
EXACT = 1 << 53              # sums of integers below this are exact in float64

# Fixed values of the score: weights are scaled by WEIGHT; an impact is
# (PEAK * tf) div (WEIGHT * tf + 8 * m), below PEAK / WEIGHT; of m, 90 parts in
# 100 go by the document's length.
WEIGHT, PEAK = 1000, 1_000_000_000
BASE, SLOPE, LENGTH = 100, 90, 8

# A term byte is a digit, a letter or part of a character beyond ASCII; only
# A-Z are lower-cased, all else is a space.
_BYTES = np.full(256, 0x20, dtype=np.uint8)
_BYTES[0x30:0x3A] = np.arange(0x30, 0x3A)
_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
_BYTES[0x61:0x7B] = np.arange(0x61, 0x7B)
_BYTES[0x80:] = np.arange(0x80, 0x100)


def terms_of(texts: pa.Array) -> W.Words:
    """The terms of each text, in order; a null text has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data and len(texts) else np.zeros(0, np.uint8)
    return W.encode(pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(_BYTES[raw].tobytes())))


def _item_terms(batches):
    """(item_id, terms): the distinct terms of each row."""
    for batch in batches:
        column = batch.column("text")
        for a, n in W.chunks(column, CHUNK_BYTES):
            w = terms_of(column.slice(a, n))
            row = np.repeat(np.arange(n), np.diff(w.bounds))
            key = np.unique(row * max(len(w.vocab), 1) + w.codes)
            row, code = np.divmod(key, max(len(w.vocab), 1))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").slice(a, n),
                 pa.ListArray.from_arrays(pa.array(ends), w.vocab.take(pa.array(code)).cast(pa.binary()))],
                ["item_id", "terms"])


def item_groups(items: DataFrame, limit: int = GROUP_BYTES) -> list[DataFrame]:
    """(item_id, term) of all items, in groups of whole items with about
    ``limit`` bytes at the most: dealt by a hash of the id, anew into twice as
    many until the largest is within the limit or holds one item only."""
    id_type = dict(items.dtypes)["item_id"]
    pairs = stored(items.select("item_id", "text").mapInArrow(_item_terms, f"item_id {id_type}, terms array<binary>")
                   .select("item_id", F.explode("terms").alias("term")).distinct(), "item-terms")
    per_item = pairs.groupBy("item_id").agg(F.sum(F.octet_length("term") + 16).alias("bytes"))
    groups = 1
    while True:
        group = F.pmod(F.xxhash64(F.lit("group"), "item_id"), F.lit(groups))
        worst = (per_item.groupBy(group.alias("g")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("items"))
                 .filter(f"bytes > {limit} and items > 1").isEmpty())
        if worst:
            return [pairs.filter(group == g) for g in range(groups)]
        groups *= 2


def _counts(vocab):
    """(doc_id, n, terms, tf): number of terms of each document, and how often
    each term of ``vocab`` (by place) occurs in it."""
    def run(batches):
        value_set = pa.array(vocab.value, pa.large_binary())
        size = max(len(value_set), 1)
        for batch in batches:
            column = batch.column("text")
            for a, n in W.chunks(column, CHUNK_BYTES):
                w = terms_of(column.slice(a, n))
                place = pc.fill_null(pc.index_in(w.vocab, value_set=value_set), -1).to_numpy().astype(np.int64)
                length = np.diff(w.bounds)
                doc, term = np.repeat(np.arange(n), length), place[w.codes]
                key, tf = np.unique((doc * size + term)[term >= 0], return_counts=True)
                doc, term = np.divmod(key, size)
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, n), pa.array(length.astype(np.int64)),
                     pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))],
                    ["doc_id", "n", "terms", "tf"])
    return run


def weights_of(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(WEIGHT * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


class Best:
    """The k best hits of each item of a block so far: larger scores first,
    equal ones by document id, null ids last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, dtype=np.int64)   # a score below it cannot be a hit
        self.hits = tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``score``: items x documents of a tile."""
        if score.shape[1] > self.k:  # what reaches the k-th score of the tile, ties included
            kth = np.partition(score, score.shape[1] - self.k, axis=1)[:, score.shape[1] - self.k]
            item, doc = np.nonzero(score >= np.maximum(kth, self.least)[:, None])
        else:
            item, doc = np.nonzero(score >= self.least[:, None])
        if not len(item):
            return
        new = (item, score[item, doc], ids[doc], null[doc])
        item, value, i, none = (np.concatenate(x) for x in zip(self.hits, new))
        by = np.lexsort((i, none, -value, item))
        item = item[by]
        first = np.r_[True, item[1:] != item[:-1]]
        at = np.arange(len(item))
        place = at - np.maximum.accumulate(np.where(first, at, 0))
        keep = by[place < self.k]
        self.hits = (item[place < self.k], value[keep], i[keep], none[keep])
        last = place == self.k - 1
        self.least[item[last]] = value[by[last]]


def _tiles(shared, k: int):
    """Hits (item, doc_id, score) of a task's documents, for all blocks of items."""
    def run(batches):
        blocks, weight = shared.value
        place = np.full(len(weight), -1, dtype=np.int64)
        width = int(max(1, min(TERM_COLUMNS, (EXACT - 1) // (max(int(weight.max(initial=0)), 1) * (PEAK // WEIGHT)))))
        best = [Best(items, k) for items, _, _, _ in blocks]
        for batch in batches:
            for a in range(0, batch.num_rows, DOC_ROWS):
                rows = batch.slice(a, DOC_ROWS)
                docs = rows.num_rows
                ids, null = rows.column("doc_id"), rows.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                lists = rows.column("terms")
                doc = np.repeat(np.arange(docs), np.diff(lists.offsets.to_numpy()))
                term, tf = lists.flatten().to_numpy(), rows.column("tf").flatten().to_numpy().astype(np.int64)
                m = rows.column("m").to_numpy()
                impact = (PEAK * tf) // (WEIGHT * tf + LENGTH * m[doc])
                for (items, columns, item, column), kept in zip(blocks, best):
                    place[columns] = np.arange(len(columns))
                    at = place[term]
                    place[columns] = -1
                    mine = at >= 0
                    if not mine.any():
                        continue
                    at, d, x = at[mine], doc[mine], impact[mine]
                    score = np.zeros((items, docs), dtype=np.int64)
                    for c in range(0, len(columns), width):
                        here, there = (at >= c) & (at < c + width), (column >= c) & (column < c + width)
                        size = min(width, len(columns) - c)
                        left, right = np.zeros((items, size)), np.zeros((size, docs))
                        left[item[there], column[there] - c] = weight[columns[column[there]]]
                        right[at[here] - c, d[here]] = x[here]
                        score += (left @ right).astype(np.int64)
                    kept.add(score, ids, null)
        base = 0
        for kept in best:
            item, value, i, none = kept.hits
            yield pa.RecordBatch.from_arrays(
                [pa.array((item + base).astype(np.int32)), pa.array(i, mask=none), pa.array(value)], ["item", "doc_id", "score"])
            base += len(kept.least)
    return run


def _blocks(item: np.ndarray, term: np.ndarray, items: int):
    """Per block of items: (number of items, its terms in order, and its pairs
    as item and place of the term within the block)."""
    out = []
    for a in range(0, items, ITEM_ROWS):
        mine = (item >= a) & (item < a + ITEM_ROWS)
        columns, column = np.unique(term[mine], return_inverse=True)
        out.append((min(ITEM_ROWS, items - a), columns, item[mine] - a, column))
    return out


def _rank_group(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame | None:
    """Hits of the items of one group, at most k for each item and task."""
    spark = docs.sparkSession
    found = pairs.toArrow()   # bounded by item_groups
    if not found.num_rows:
        return None
    ids, terms = (found.column(c).combine_chunks().dictionary_encode(null_encoding="encode") for c in ("item_id", "term"))
    vocab = spark.sparkContext.broadcast(terms.dictionary.to_pylist())
    counts = stored(docs.mapInArrow(_counts(vocab), "doc_id long, n long, terms array<int>, tf array<int>"), "impacts")
    total = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 0
    if not n_terms:
        return None
    df = np.zeros(len(terms.dictionary), dtype=np.int64)
    per_term = counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow()
    df[per_term.column("t").to_numpy()] = per_term.column("df").to_numpy()
    blocks = _blocks(ids.indices.to_numpy().astype(np.int64), terms.indices.to_numpy().astype(np.int64), len(ids.dictionary))
    shared = spark.sparkContext.broadcast((blocks, weights_of(n_docs, df)))
    m = F.expr(f"{BASE - SLOPE} + (cast({SLOPE} * n as decimal(38,0)) * {n_docs}BD) div {n_terms}BD")
    hits = counts.filter("size(terms) > 0").select("doc_id", "terms", "tf", m.alias("m")).mapInArrow(
        _tiles(shared, k), "item int, doc_id long, score long")
    names = stored(spark.createDataFrame(pa.table({"item": pa.array(range(len(ids.dictionary)), pa.int32()),
                                                   "item_id": ids.dictionary})), "items")
    return best_hits(hits, "item", k).join(names, "item").select("item_id", "rank", "doc_id", "score")


def best_hits(hits: DataFrame, by: str, k: int) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank(docs: DataFrame, items: DataFrame, k: int = 10, text_col: str = "text", id_col: str = "doc_id",
         group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item of ``items`` (item_id,
    text) the k documents with the highest score above 0, equal scores by
    ascending id.

    Every row of ``docs`` is a document of its own: rows that repeat count and
    may be listed as often; null ids come last among equal scores. A null or
    empty text has no terms and counts nowhere. Rows of one item id are one
    item with all their terms; a null item id is an item too. An item without
    a term that occurs has no rows. Empty tables give no rows."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    groups = [_rank_group(docs, pairs, k) for pairs in item_groups(items.select("item_id", "text"), group_bytes)]
    groups = [g for g in groups if g is not None]
    if not groups:
        return docs.sparkSession.createDataFrame(
            [], f"item_id {dict(items.dtypes)['item_id']}, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionByName, groups)
