"""Suffix-array dedup with sparse suffix arrays (operator 8).

A passage is repeated if ``length`` of its consecutive words occur at another
place too. Of all suffixes, only those are kept that start at a minimiser: the
``gram``-word gram with the smallest hash among those of a window of
``length`` words. The choice depends on the window's words alone, so equal
passages keep the same suffixes, one in fourteen or so.

1. Grams at kept positions are counted over the corpus by hash; positions whose
   gram is alone are dropped.
2. Each kept suffix travels with the words left and right of it that a
   passage through it can reach, packed, to the bucket of its gram. There the
   suffixes are sorted, and neighbours are compared word by word: a common
   prefix shorter than the gram drops a suffix.
3. Matches are extended left and right: the windows around the suffixes of
   a class are grouped by their words, exactly.

A map task settles what repeats within its own chunk and ships one copy of it,
so a hot passage reaches its bucket once per chunk. Windows at a passage's edges
hold words of their own document and are not settled so: where a gram is in more
than a share of the kept positions, each of its windows goes to the bucket of
the whole window's hash, which equal windows share. Buckets grow in number with
the input, not in size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .runtime import prepare, shuffle_width, stored
from .superkmers import (BLOCK, BUCKET_BYTES, CHUNK_BYTES, among, block_rows, by_spelling, dense_rank,
                         keyed, open_blocks, pack_places, packed_runs, read_places)

LENGTH = 50
GRAM = 24
HIGH = np.uint64(0xFFFFFFFF00000000)
LOW = np.uint64(0xFFFFFFFF)

MARK = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("version", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("later", T.BooleanType())])


def anchors(h: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(place of the smallest gram of each window, gram hashes), by word."""
    grams = W.window_hash(h, gram)
    if len(h) < length:
        return np.zeros(0, dtype=np.int64), grams
    order = (W.mix(grams) & HIGH) | np.arange(len(grams), dtype=np.uint64)
    return (W.window_min(order, length - gram + 1) & LOW).astype(np.int64), grams


def _positions(length: int, gram: int):
    def run(batches):
        for batch in batches:
            for a, n in W.chunks(batch.column("text"), CHUNK_BYTES):
                part = batch.slice(a, n)
                w = W.encode(part.column("text"))
                place, grams = anchors(W.hash_words(w.vocab)[w.codes], length, gram)
                at = np.unique(place[W.starts_inside(w.bounds, length)[:len(place)]])
                doc = np.searchsorted(w.bounds, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grams[at].view(np.int64)), part.column("doc").take(pa.array(doc)),
                     part.column("version").take(pa.array(doc)), pa.array(at - w.bounds[doc])],
                    ["gram", "doc", "version", "place"])
    return run


def grouped_windows(hashes, codes, starts, length, order) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows that occur at another place too, whether each also starts
    earlier, all windows that are not the first of their content)."""
    dup, head = W.equal_windows(hashes, codes, starts, length, order)
    later = order[dup] > order[dup[head]]
    shared = np.zeros(len(dup), dtype=bool)
    shared[head[later]] = True
    shared = shared[head]
    return dup[shared], later[shared], dup[head != np.arange(len(dup))]


def _marks(doc, version, start, n, later) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, version, start, n, later)], MARK.names)


def _suffixes(buckets: int, hot: np.ndarray, length: int, gram: int):
    """Blocks of the windows around repeated grams. Rows without codes carry
    what the chunk itself has settled; ``vocab`` then tells later windows (b"1")
    from first ones."""
    def run(batches):
        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for a, n in W.chunks(batch.column("text"), CHUNK_BYTES):
                part = batch.slice(a, n)
                ids, version = part.column("doc").to_numpy(), part.column("version").to_numpy()
                w = by_spelling(W.encode(part.column("text")))
                h = W.hash_words(w.vocab)[w.codes]
                place, grams = anchors(h, length, gram)
                wanted = np.zeros(len(w.codes) + 1, dtype=bool)
                lists = part.column("places")
                own = np.repeat(w.bounds[:-1], np.asarray(pc.list_value_length(lists)))
                wanted[own + lists.flatten().to_numpy()] = True
                starts = np.flatnonzero(W.starts_inside(w.bounds, length)[:len(place)] & wanted[place])
                if not len(starts):
                    continue
                hashes = W.window_hash(h, length)[starts]
                doc = np.searchsorted(w.bounds, starts, side="right") - 1
                inside = starts - w.bounds[doc]
                order = (dense_rank(ids)[doc] << 32) | inside
                shared, later, rest = grouped_windows(hashes, w.codes, starts, length, order)
                for flag, some in ((b"1", np.sort(shared[later])), (b"0", np.sort(shared[~later]))):
                    first, count = W.runs_of(starts[some], doc[some])
                    if len(first):
                        at = some[first]
                        yield block_rows([int(ids[0]) % buckets], [flag], [None],
                                         [pack_places(ids[doc[at]], version[doc[at]], inside[at], count, zip_)])
                ship = np.ones(len(starts), dtype=bool)
                ship[rest] = False
                keep = np.flatnonzero(ship)
                own = grams[place[starts[keep]]]
                route = W.mix(own)
                if len(hot):
                    route = np.where(among(own, hot), W.mix(hashes[keep]), route)
                route = (route % np.uint64(buckets)).astype(np.int32)
                first, count = W.runs_of(starts[keep], doc[keep], place[starts[keep]], route)
                at = keep[first]
                yield from packed_runs(w, starts[at], count, route[first], ids[doc[at]], version[doc[at]],
                                       inside[at], length, zip_)
    return run


def matched(codes: np.ndarray, suffix: np.ndarray, gram: int) -> np.ndarray:
    """Which suffixes share their first ``gram`` words with another: sort them,
    compare neighbours."""
    by = np.lexsort([codes[suffix + j] for j in reversed(range(gram))])
    same = np.ones(max(0, len(by) - 1), dtype=bool)
    for j in range(gram):
        word = codes[suffix[by] + j]
        same &= word[1:] == word[:-1]
    out = np.zeros(len(by), dtype=bool)
    out[by[1:]] = same
    out[by[:-1]] |= same
    return out


def _extend(blocks: list[tuple], length: int, gram: int):
    """Of one bucket: the repeated windows, as marks."""
    codes, by_word, run = open_blocks(*zip(*blocks))
    ends = np.cumsum(run["n"] + (length - 1))
    begins = ends - run["n"] - (length - 1)
    h = by_word[codes]
    place, _ = anchors(h, length, gram)
    own = np.flatnonzero(matched(codes, place[begins], gram))
    starts = W.ragged(begins[own], run["n"][own])
    of = np.repeat(own, run["n"][own])
    inside = run["start"][of] + (starts - begins[of])
    order = (dense_rank(run["doc"])[of] << 32) | inside
    shared, later, _ = grouped_windows(W.window_hash(h, length)[starts], codes, starts, length, order)
    for flag, some in ((True, np.sort(shared[later])), (False, np.sort(shared[~later]))):
        first, count = W.runs_of(starts[some], of[some])
        at = some[first]
        yield _marks(run["doc"][of[at]], run["version"][of[at]], inside[at], count, np.full(len(at), flag))


def _arrays(length: int, gram: int):
    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        now, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["codes"] is None:
                    p = read_places(row["runs"], unzip)
                    yield _marks(p["doc"], p["version"], p["start"], p["n"],
                                 np.full(len(p["doc"]), row["vocab"] == b"1"))
                    continue
                if held and row["bucket"] != now:
                    yield from _extend(held, length, gram)
                    held = []
                now = row["bucket"]
                held.append((row["vocab"], row["codes"], row["runs"]))
        if held:
            yield from _extend(held, length, gram)
    return run


def _passages(length: int):
    """Marks of one document each -> its passages."""
    def run(batches):
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for doc, marks in zip(batch.column("doc").to_pylist(), batch.column("marks").to_pylist()):
                rows = np.array([(m["start"], m["start"] + m["n"] + length - 1, m["later"]) for m in marks])
                rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
                reach = np.maximum.accumulate(rows[:, 1])
                new = np.concatenate([[True], rows[1:, 0] > reach[:-1]])
                starts = rows[new, 0]
                ends = reach[np.append(np.flatnonzero(new)[1:], len(rows)) - 1]
                gone = np.zeros(len(starts), dtype=np.int64)
                late = rows[rows[:, 2] == 1]
                if len(late):
                    far = np.maximum.accumulate(late[:, 1])
                    fresh = np.maximum(late[:, 0], np.concatenate([[0], far[:-1]]))
                    np.add.at(gone, np.searchsorted(starts, late[:, 0], side="right") - 1,
                              np.maximum(late[:, 1] - fresh, 0))
                for column, x in zip(out, ([doc] * len(starts), starts, ends - starts, gone)):
                    column.extend(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out],
                                             ["doc", "start", "n_words", "n_removed"])
    return run


def repeated_marks(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc, version, start, n, later): runs of n windows of ``length`` words, the
    first starting at word ``start``, that occur at another place; ``later``
    if they also start earlier (smaller id, or earlier in the same document).
    A window may be marked more than once."""
    prepare(docs.sparkSession)
    blocks, buckets = _blocks(keyed(docs, id_col, text_col), length, gram)
    return (blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_arrays(length, gram), MARK))


def _blocks(rows: DataFrame, length: int, gram: int) -> tuple[DataFrame, int]:
    """(blocks of the windows around repeated grams, number of buckets)."""
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_width(spark), -(-total // BUCKET_BYTES))
    kept = stored(rows.mapInArrow(_positions(length, gram),
                                  "gram long, doc long, version long, place long"), "suffixes")
    # written, so that both sides of the join are dealt anew and a hot gram's rows can be split
    shared = stored(kept.groupBy("gram").count().filter("count > 1"), "grams")
    least = max(16, kept.count() // (2 * buckets))  # at most 2 * buckets grams have more
    often = shared.filter(F.col("count") > least).select("gram").collect()
    hot = np.sort(np.array([r["gram"] for r in often], dtype=np.int64).view(np.uint64))
    places = (kept.join(shared.select("gram"), "gram", "left_semi").groupBy("doc", "version")
              .agg(F.collect_set("place").alias("places")))
    return rows.join(places, ["doc", "version"]).mapInArrow(_suffixes(buckets, hot, length, gram), BLOCK), buckets


def repeated_passages(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, n_words, n_removed): the maximal stretches of words of
    each document that repeated windows cover, from word ``start`` on, and
    how many of these words lie in windows that also start earlier, which
    dedup removes. Documents without such a stretch have no row.

    A null text has no words. Null ids come before all others and count as
    one id. A row that repeats id and text is the same place, so it has the
    same rows once and repeats nothing by itself. Texts shorter than
    ``length`` words have none. An empty table gives an empty result.
    """
    marks = (repeated_marks(docs, length, gram, id_col, text_col).groupBy("doc", "version")
             .agg(F.collect_list(F.struct("start", "n", "later")).alias("marks")))
    out = marks.mapInArrow(_passages(length), "doc long, start long, n_words long, n_removed long")
    null = F.col("doc") == -(1 << 63)
    return out.select(F.when(~null, F.col("doc")).alias("doc_id"), "start", "n_words", "n_removed")
