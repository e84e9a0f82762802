"""Substring dedup by super-k-mer partitioning (operator 9).

A window is ``width`` consecutive words of one document. Windows are hashed
to buckets by their minimiser, the smallest hash of the ``gram``-word grams
they hold. Consecutive windows share most of their grams, so runs of them
share the minimiser and travel as one packed string of words, a super-k-mer,
about three words to a window where single windows would need ``width``. In
a bucket, windows are sorted and equal ones compared word by word; all but
the earliest occurrence are marked, and the marks return to their documents.

Scale and skew: a map task marks what repeats within its own chunk of
documents and ships a window's first occurrence only, so a group of copies or
a common passage reaches its bucket once per chunk, not once per document.
Minimisers that a bounded sample shows in more than a share of the windows
are split by a second minimiser, and pairs of both that are as frequent by the
whole window's hash (the sample changes the routing, never the result). Buckets grow in number with the input, not in size.
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

WINDOW = 20
GRAM = 4
CHUNK_BYTES = 8 << 20        # text that a task holds at a time
BUCKET_BYTES = 12 << 20      # text for each bucket
PIECE_WORDS = 1 << 20        # words hashed at a time in a bucket
SAMPLE_BYTES = 16 << 20      # text read to find frequent minimisers

BLOCK = T.StructType([
    T.StructField("bucket", T.IntegerType()), T.StructField("vocab", T.BinaryType()),
    T.StructField("codes", T.BinaryType()), T.StructField("runs", T.BinaryType())])
MARK = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("version", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("n", T.LongType())])
# Runs of windows; columns are stored one after the other, which compresses best,
# and a text's id and version once for all its consecutive runs.
TEXTS = (("doc", "<i8"), ("version", "<i8"), ("runs", "<u4"))
RUNS = (("start", "<u4"), ("n", "<u4"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, version, text): an id that orders and identifies a row, null ids
    first; rows of one id with different texts are told apart by version."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"),
                       version(text_col).alias("version"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def version(text_col: str):
    """A 64-bit hash that tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def dense_rank(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1].astype(np.int64)


def _minimisers(h: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    grams = W.mix(W.window_hash(h, gram))
    return W.window_min(grams, width - gram + 1), grams


def _pairs(low: np.ndarray, grams: np.ndarray, width: int, gram: int) -> np.ndarray:
    """One hash of each window's first and second minimiser."""
    return W.mix(low ^ W.window_min(W.mix(grams), width - gram + 1))


def _frequent(docs: DataFrame, total: int, width: int, gram: int, share: float) -> np.ndarray:
    """Minimisers, and pairs of first and second ones, of more than ``share`` of
    a sample's windows: at most 2 / share values, whatever the input."""
    def count(batches):
        for batch in batches:
            for a, n in W.chunks(batch.column(0), CHUNK_BYTES):
                w = W.encode(batch.column(0).slice(a, n))
                m, grams = _minimisers(W.hash_words(w.vocab)[w.codes], width, gram)
                inside = W.starts_inside(w.bounds, width)[:len(m)]
                m = np.concatenate([m[inside], _pairs(m, grams, width, gram)[inside]])
                m, k = np.unique(m, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m.view(np.int64)), pa.array(k.astype(np.int64))], ["m", "k"])

    part = docs.select("text").sample(min(1.0, SAMPLE_BYTES / max(total, 1)), seed=7)
    counted = stored(part.mapInArrow(count, "m long, k long").groupBy("m").agg(F.sum("k").alias("k")), "minimisers")
    seen = (counted.agg(F.sum("k")).first()[0] or 0) // 2  # each window is in twice
    rows = counted.filter((F.col("k") > seen * share) & (F.col("k") >= 16)).select("m").collect()
    return np.sort(np.array([r.m for r in rows], dtype=np.int64).view(np.uint64))


def among(x: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in ``hot``, which is sorted and not empty."""
    return hot[np.minimum(np.searchsorted(hot, x), len(hot) - 1)] == x


def by_spelling(w: W.Words) -> W.Words:
    """The same words with codes in the vocabulary's order: vocabularies of
    buckets come sorted, which compresses best."""
    by = pc.sort_indices(w.vocab).to_numpy()
    rank = np.empty(len(by), dtype=np.int32)
    rank[by] = np.arange(len(by), dtype=np.int32)
    return W.Words(rank[w.codes], w.bounds, w.vocab.take(pa.array(by)))


def _split(buckets: int, hot: np.ndarray, width: int, gram: int):
    def run(batches):
        zip_ = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for a, n in W.chunks(batch.column("text"), CHUNK_BYTES):
                part = batch.slice(a, n)
                ids = part.column("doc").to_numpy()
                version = part.column("version").to_numpy()
                w = by_spelling(W.encode(part.column("text")))
                h = W.hash_words(w.vocab)[w.codes]
                windows = W.window_hash(h, width)
                starts = np.flatnonzero(W.starts_inside(w.bounds, width)[:len(windows)])
                if not len(starts):
                    continue
                hashes = windows[starts]
                doc = np.searchsorted(w.bounds, starts, side="right") - 1
                inside = starts - w.bounds[doc]
                order = (dense_rank(ids)[doc] << 32) | inside
                dup, head = W.equal_windows(hashes, w.codes, starts, width, order)
                later = dup[order[dup] > order[dup[head]]]
                ship = np.ones(len(starts), dtype=bool)
                ship[later] = False
                del hashes, order, dup, head
                marks = np.sort(later)
                first, length = W.runs_of(starts[marks], doc[marks])
                if len(first):
                    at = marks[first]
                    yield block_rows([int(ids[0]) % buckets], [None], [None],
                                [pack_places(ids[doc[at]], version[doc[at]], inside[at], length, zip_)])
                low, grams = _minimisers(h, width, gram)
                route = low
                if len(hot):
                    pair = _pairs(low, grams, width, gram)
                    pair = np.where(among(pair, hot), W.mix(windows), pair)
                    route = np.where(among(low, hot), pair, low)
                    del pair
                route = (route % np.uint64(buckets)).astype(np.int32)
                del windows
                del low, grams, h
                keep = np.flatnonzero(ship)
                first, length = W.runs_of(starts[keep], doc[keep], route[starts[keep]])
                at = keep[first]
                to = route[starts[at]]
                yield from packed_runs(w, starts[at], length, to, ids[doc[at]], version[doc[at]],
                                       inside[at], width, zip_)
    return run


def packed_runs(w: W.Words, at: np.ndarray, n: np.ndarray, to: np.ndarray, ids: np.ndarray,
                version: np.ndarray, inside: np.ndarray, width: int, zip_):
    """One block for each bucket ``to`` of the runs of ``n`` windows that start
    at the words ``at``: a sorted vocabulary, the words as codes of it, and
    where each run is from."""
    by = np.argsort(to, kind="stable")
    at, n, to, ids, version, inside = at[by], n[by], to[by], ids[by], version[by], inside[by]
    edges = np.flatnonzero(np.diff(to, prepend=-1, append=-1))
    lut = np.zeros(len(w.vocab), dtype=np.int32)
    for i, j in zip(edges[:-1], edges[1:]):
        codes = w.codes[W.ragged(at[i:j], n[i:j] + (width - 1))]
        used = np.unique(codes)
        lut[used] = np.arange(len(used), dtype=np.int32)
        small, mark = (np.uint16, b"2") if len(used) <= 1 << 16 else (np.uint32, b"4")
        vocab = b"\n".join(w.vocab.take(pa.array(used)).to_pylist())
        yield block_rows([int(to[i])], [zip_.compress(vocab)],
                    [mark + zip_.compress(lut[codes].astype(small).tobytes())],
                    [pack_places(ids[i:j], version[i:j], inside[i:j], n[i:j], zip_)])


def pack_places(ids, version, start, n, zip_) -> bytes:
    new = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (version[1:] != version[:-1])]))
    columns = (ids[new], version[new], np.diff(np.append(new, len(ids))), start, n)
    head = len(new).to_bytes(8, "little")
    return zip_.compress(head + b"".join(x.astype(t).tobytes() for x, (_, t) in zip(columns, TEXTS + RUNS)))


def read_places(blob: bytes, unzip) -> dict[str, np.ndarray]:
    raw = unzip.decompress(blob)
    texts, at = int.from_bytes(raw[:8], "little"), 8
    runs = (len(raw) - at - texts * sum(np.dtype(t).itemsize for _, t in TEXTS)) // sum(
        np.dtype(t).itemsize for _, t in RUNS)
    out = {}
    for fields, count in ((TEXTS, texts), (RUNS, runs)):
        for name, t in fields:
            out[name] = np.frombuffer(raw, dtype=t, count=count, offset=at).astype(np.int64)
            at += count * np.dtype(t).itemsize
    each = out.pop("runs")
    return out | {name: np.repeat(out[name], each) for name in ("doc", "version")}


def block_rows(bucket, vocab, codes, runs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(vocab, pa.binary()), pa.array(codes, pa.binary()),
         pa.array(runs, pa.binary())], BLOCK.names)


def mark_rows(runs: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(runs[c]) for c in MARK.names], MARK.names)


def open_blocks(vocabs: list[bytes], codes: list[bytes], runs: list[bytes]):
    """(words as codes, hash of each code's word, runs) of a bucket's blocks."""
    unzip = zstandard.ZstdDecompressor()
    known: dict[bytes, int] = {}
    parts = []
    for v, c in zip(vocabs, codes):
        lut = np.array([known.setdefault(x, len(known)) for x in unzip.decompress(v).split(b"\n")],
                       dtype=np.int32)
        kind = np.uint16 if c[:1] == b"2" else np.uint32
        parts.append(lut[np.frombuffer(unzip.decompress(c[1:]), dtype=kind)])
    flat = np.concatenate(parts)
    del parts
    tables = [read_places(r, unzip) for r in runs]
    run = {name: np.concatenate([t[name] for t in tables]) for name in MARK.names}
    return flat, W.hash_words(pa.array(known.keys(), pa.large_binary())), run


def _repeats(vocabs: list[bytes], codes: list[bytes], runs: list[bytes], width: int) -> dict:
    """Of one bucket: the runs of windows that also start earlier."""
    flat, by_word, run = open_blocks(vocabs, codes, runs)
    ends = np.cumsum(run["n"] + (width - 1))
    begins = ends - run["n"] - (width - 1)
    starts = W.ragged(begins, run["n"])
    hashes = np.empty(len(starts), dtype=np.uint64)
    upto = np.concatenate([[0], np.cumsum(run["n"])])
    a = 0
    while a < len(ends):  # whole runs at a time
        b = max(a + 1, int(np.searchsorted(ends, begins[a] + PIECE_WORDS, side="right")))
        h = W.window_hash(by_word[flat[begins[a]:ends[b - 1]]], width)
        hashes[upto[a]:upto[b]] = h[starts[upto[a]:upto[b]] - begins[a]]
        a = b
    of = np.repeat(np.arange(len(ends), dtype=np.int32), run["n"])
    inside = run["start"][of] + (starts - begins[of])
    order = (dense_rank(run["doc"])[of] << 32) | inside
    dup, head = W.equal_windows(hashes, flat, starts, width, order)
    later = np.sort(dup[order[dup] > order[dup[head]]])
    first, length = W.runs_of(starts[later], of[later])
    at = later[first]
    return {"doc": run["doc"][of[at]], "version": run["version"][of[at]], "start": inside[at],
            "n": length}


def _count(width: int):
    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        now, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["codes"] is None:
                    yield mark_rows(read_places(row["runs"], unzip))
                    continue
                if held and row["bucket"] != now:
                    yield mark_rows(_repeats(*zip(*held), width))
                    held = []
                now = row["bucket"]
                held.append((row["vocab"], row["codes"], row["runs"]))
        if held:
            yield mark_rows(_repeats(*zip(*held), width))
    return run


def repeated_windows(docs: DataFrame, width: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """From (doc, version, text): one row (doc, version, start, n) for each run
    of n consecutive windows, the first starting at word ``start``, that also
    start earlier: in a smaller doc, or earlier in the same one."""
    prepare(docs.sparkSession)
    blocks, buckets = _blocks(docs, width, gram)
    return (blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(_count(width), MARK))


def _blocks(docs: DataFrame, width: int, gram: int) -> tuple[DataFrame, int]:
    """(blocks of the windows, number of buckets)."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_width(docs.sparkSession), -(-total // BUCKET_BYTES))
    hot = _frequent(docs, total, width, gram, 1 / (2 * buckets))
    return docs.mapInArrow(_split(buckets, hot, width, gram), BLOCK), buckets


def _strike(width: int, text_at: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).cast(pa.large_binary()).to_pylist()
            starts, lengths = batch.column("starts"), batch.column("lengths")
            n_words, n_removed, kept = [], [], []
            for i, text in enumerate(texts):
                own = (text or b"").split()
                n = len(own)
                gone = 0
                if starts[i].is_valid and n:
                    cover = np.zeros(n + 1, dtype=np.int64)
                    a = np.asarray(starts[i].values)
                    np.add.at(cover, a, 1)
                    np.add.at(cover, a + np.asarray(lengths[i].values) + (width - 1), -1)
                    left = np.cumsum(cover[:-1]) == 0
                    own = [x for x, k in zip(own, left.tolist()) if k]
                    gone = n - len(own)
                n_words.append(n)
                n_removed.append(gone)
                kept.append(b" ".join(own))
            out = [batch.column(i) for i in range(batch.num_columns - 2)]
            out += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(out, [f"c{i}" for i in range(len(out))])
    return run


def remove_repeated_words(docs: DataFrame, width: int = WINDOW, gram: int = GRAM,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` and (n_words, n_removed, kept_text): each row's
    text without the words of any ``width``-word window that also starts
    earlier (smaller id, or earlier in the same document), the kept words
    joined by one space. Windows are judged on the input.

    A null text has no words. Null ids come before all others and count as
    one id. Rows that repeat id and text are judged alike: neither is earlier
    than the other. Rows of one id with different texts are ordered by the
    window's place. An empty table gives an empty result.
    """
    docs = docs.drop("n_words", "n_removed", "kept_text")  # replaced by the new ones
    names = docs.columns
    rows = docs.toDF(*(f"c{i}" for i in range(len(names))))
    at_id, at_text = names.index(id_col), names.index(text_col)
    keys = keyed(rows, f"c{at_id}", f"c{at_text}")
    marks = (repeated_windows(keys, width, gram).groupBy("doc", "version")
             .agg(F.collect_list(F.struct("start", "n")).alias("m"))
             .select("doc", "version", F.col("m.start").alias("starts"),
                     F.col("m.n").alias("lengths")))
    own = rows.withColumns({
        "doc": F.coalesce(F.col(f"c{at_id}").cast("long"), F.lit(-(1 << 63))),
        "version": version(f"c{at_text}")})
    joined = own.join(marks, ["doc", "version"], "left").drop("doc", "version")
    k = len(names)
    schema = T.StructType([*rows.schema.fields, T.StructField(f"c{k}", T.LongType()),
                           T.StructField(f"c{k + 1}", T.LongType()),
                           T.StructField(f"c{k + 2}", T.StringType())])
    out = joined.mapInArrow(_strike(width, at_text), schema)
    return out.toDF(*names, "n_words", "n_removed", "kept_text")
