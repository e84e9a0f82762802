"""Lexical retrieval packing (operator 2).

Documents are cut and joined to sequences of ``WINDOW`` tokens. A seed document
opens a window; a BM25 search with all tokens it shares over an inverted
index of its shard returns unused neighbours, which fill the window greedily,
best first: those that fit whole, then the best one left, cut where the window
ends. If all that a search returned are used and room is left, it asks again. What is cut off seeds the next window. A shard's last window is cut into
powers of two, which need no padding, so nothing is padded.

BM25's counts (documents, lengths, document frequencies of token ids, at most
one row for each id of the vocabulary) are those of the whole corpus. The
index is sharded by each document's last-learned token: a BPE vocabulary is
ordered by frequency, so that is its rarest one, and documents that share it
meet in a shard. Shards hold about ``SHARD_TOKENS``; a token with more than that
is split by a hash of the row, so no shard grows with a hot group, not even with
one of identical rows. Retrieval is within a shard: the README has the measured
share of whole-corpus neighbours that it sees.
"""

from __future__ import annotations

import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .runtime import prepare, shuffle_width, stored

WINDOW = 2048
END_ID = 1
NEIGHBOURS = 32         # asked for at first; twice as many each time until the window is full
COMMON = 16             # tokens of over one in so many of a shard's documents are scored as a matrix
SHARD_TOKENS = 1 << 20
BUCKETS = 4096          # rows of the driver's table of shard sizes
K1, B = 1.2, 0.75       # BM25
KNOWN_WORDS = 200_000   # parts of words that a Python worker remembers, twice over
CHUNK_BYTES = 1 << 23   # of text that are encoded at once
CHUNK_TOKENS = 1 << 21  # whose documents are counted at once


class WordIds(dict):
    """Token ids of the parts that a lower-casing BPE tokenizer with word ends
    splits words into, packed, by an exact reading of it.

    White space separates pre-tokens and is dropped, so the distinct words of
    a chunk of texts are encoded, each once, and the parts that they share are
    remembered. Words of printable characters below U+0300 are in NFC; they
    are lower-cased and split here by the tokenizer's own pattern, all in one
    pass. All others go through the tokenizer.
    """

    # Fixed value: the pattern of the tokenizer's file; a line is a word.
    PATTERN = regex.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.size = self.tokenizer.get_vocab_size()
        # the first number that is no id ends a word
        self.dtype = np.dtype("<u2" if self.size < 1 << 16 else "<u4")
        self.older: dict[str, bytes] = {}
        # Byte-level alphabet: printable bytes stand for themselves, the
        # others for the characters from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.letters = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def pack(self, ids: list[int]) -> bytes:
        return array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes()

    def __missing__(self, part: str) -> bytes:
        found = self.older.get(part)
        if found is None:
            if part == "\n":
                found = self.pack([self.size])
            else:
                spelt = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
                found = self.pack([t.id for t in self.merge(spelt)])
        if len(self) >= KNOWN_WORDS:
            self.older = dict(self)
            self.clear()
        self[part] = found
        return found

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def of_words(self, words: pa.Array) -> pa.Array:
        """The packed ids of distinct words, as large binary."""
        if not len(words):
            return pa.array([], pa.large_binary())
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), pa.scalar(b"\n", words.type))
        lines = joined[0].as_py().decode("utf-8", "replace")
        low = lines.lower()
        points = np.frombuffer(low.encode("utf-32-le"), dtype="<u4")
        plain = (points - 33 < 94) | (points - 0xA1 < 0x25F) | (points == 10)
        odd = np.unique(np.cumsum(points == 10)[~plain]).tolist()
        if odd:
            lines, left = lines.split("\n"), low.split("\n")
            for i in odd:
                left[i] = ""
            low = "\n".join(left)
        parts = self.PATTERN.findall(low)
        parts.append("\n")
        ids = np.frombuffer(b"".join(map(self.__getitem__, parts)), dtype=self.dtype)
        line_ends = ids == self.size
        ends = np.flatnonzero(line_ends)
        found = self.packed(ids[~line_ends], ends - np.arange(len(ends)))
        if odd:
            found = pa.concat_arrays([found, pa.array([self.whole(lines[i]) for i in odd], pa.large_binary())])
            at = np.arange(len(words))
            at[odd] = len(words) + np.arange(len(odd))
            found = found.take(pa.array(at))
        return found

    def packed(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """``ids`` cut at ``ends``, as large binary."""
        offsets = np.concatenate([[0], ends]).astype(np.int64) * self.dtype.itemsize
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends),
                                                [None, pa.py_buffer(offsets), pa.py_buffer(ids)])

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, each with id 1 at its end, and their ends."""
        special = pc.fill_null(pc.match_substring(texts, "<|"), False)  # tokens found before the split
        rows = np.flatnonzero(special.to_numpy(zero_copy_only=False))
        others = pa.array(np.arange(len(texts)), mask=special.to_numpy(zero_copy_only=False))
        split = W.encode(texts.take(others))  # a copy, as Arrow misreads some slices; nulls have no words
        # a text's last "word" is id 1, after all of a text with special tokens
        end = self.pack([END_ID])
        last = [end] + [self.whole(x.decode("utf-8", "replace")) + end
                        for x in texts.take(pa.array(rows)).cast(pa.large_binary()).to_pylist()]
        words = pa.concat_arrays([self.of_words(split.vocab), pa.array(last, pa.large_binary())])
        closing = np.full(len(texts), len(split.vocab), dtype=np.int32)
        closing[rows] += np.arange(1, len(last), dtype=np.int32)
        ids = words.take(pa.array(np.insert(split.codes, split.bounds[1:], closing)))
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, dtype=np.int64)[split.bounds[1:] + np.arange(1, len(texts) + 1)]
        return np.frombuffer(data, dtype=self.dtype, count=ends[-1] // self.dtype.itemsize), ends // self.dtype.itemsize

    def of_text(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        ids, _ = self.of_texts(pa.array([text], pa.large_binary()).view(pa.large_string()))
        return ids[:-1].tobytes()


_OPEN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One per Python worker."""
    if path not in _OPEN:
        _OPEN[path] = WordIds(path)
    return _OPEN[path]


def forget_words() -> None:
    """A worker that packs has no more words to encode: what it remembers of
    them would only lie beside its index, and beside all that it does later."""
    if TaskContext.get() is not None:  # not in the driver
        _OPEN.clear()


TOKENS = "doc_id long, text_hash long, ids binary, n long, rarest int, token int, df long"


def _tokenize(path: str):
    def counts(df):
        seen = np.flatnonzero(df)
        k = len(seen)
        return _row_batch([None] * k, [None] * k, [None] * k, [None] * k, [None] * k,
                          seen.astype(np.int32), df[seen])

    def run(batches):
        known = word_ids(path)
        df = np.zeros(known.size, dtype=np.int64)
        for batch in batches:
            keys, hashes = batch.column("doc_id"), batch.column("text_hash")
            texts = batch.column("text").cast(pa.large_string())
            for a, k in W.chunks(texts, CHUNK_BYTES):
                flat, ends = known.of_texts(texts.slice(a, k))
                n = np.diff(ends, prepend=0)
                _count(df, flat, n)
                yield _row_batch(keys.slice(a, k), hashes.slice(a, k), known.packed(flat, ends).cast(pa.binary()), n,
                                 np.maximum.reduceat(flat, ends - n), [None] * k, [None] * k)
        yield counts(df)
    return run


def _count(df: np.ndarray, flat: np.ndarray, n: np.ndarray) -> None:
    """Add to ``df`` how many of the documents hold each token."""
    ends = np.cumsum(n)
    a = 0
    while a < len(n):
        base = ends[a] - n[a]
        b = max(a + 1, int(np.searchsorted(ends, base + CHUNK_TOKENS, side="right")))
        pairs = np.repeat(np.arange(b - a, dtype=np.uint64) << np.uint64(32), n[a:b]) | flat[base:ends[b - 1]]
        pairs.sort()
        new = np.ones(len(pairs), dtype=bool)
        new[1:] = pairs[1:] != pairs[:-1]
        df += np.bincount((pairs[new] & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=len(df))
        a = b


def _row_batch(doc_id, text_hash, ids, n, rarest, token, df) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id, pa.int64()), pa.array(text_hash, pa.int64()), pa.array(ids, pa.binary()),
         pa.array(n, pa.int64()), pa.array(rarest, pa.int32()), pa.array(token, pa.int32()),
         pa.array(df, pa.int64())],
        ["doc_id", "text_hash", "ids", "n", "rarest", "token", "df"])


class Index:
    """BM25 over the documents of one shard: postings by token, each with
    its weight."""

    def __init__(self, flat: np.ndarray, n: np.ndarray, idf: np.ndarray, mean: float):
        docs = len(n)
        pairs = np.repeat(np.arange(docs, dtype=np.uint64) << np.uint64(32), n) | flat
        pairs.sort()
        first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        tf = np.diff(np.append(first, len(pairs)))
        pairs = pairs[first]
        self.doc = (pairs >> np.uint64(32)).astype(np.int32)
        self.token = (pairs & np.uint64(0xFFFFFFFF)).astype(np.int32)
        norm = K1 * (1 - B + B * n / mean)
        self.weight = (idf[self.token] * (tf * (K1 + 1) / (tf + norm[self.doc]))).astype(np.float32)
        self.bounds = np.searchsorted(self.doc, np.arange(docs + 1))
        small = self.token.astype(np.uint16) if len(idf) <= 1 << 16 else self.token
        by = np.argsort(small, kind="stable")
        self.posting_doc, self.posting_weight = self.doc[by], self.weight[by]
        count = np.bincount(self.token, minlength=len(idf))
        self.ends = np.cumsum(count)
        self.begins = self.ends - count
        # Weights of common tokens as a matrix, at most COMMON cells a posting.
        common = np.flatnonzero(count > max(1, docs // COMMON))
        self.column = np.full(len(idf), -1, dtype=np.int32)
        self.column[common] = np.arange(len(common), dtype=np.int32)
        self.matrix = np.zeros((docs, len(common)), dtype=np.float32)
        own = self.column[self.token]
        self.matrix[self.doc[own >= 0], own[own >= 0]] = self.weight[own >= 0]

    def search(self, doc: int, unused: np.ndarray, most: int) -> list[int]:
        """The unused documents nearest to ``doc``, best first, ties by place."""
        return self.nearest(self.scores(doc), unused, most)

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of each document for all tokens of ``doc``."""
        tokens = self.token[self.bounds[doc]:self.bounds[doc + 1]]
        column = self.column[tokens]
        asked = np.zeros(self.matrix.shape[1], dtype=np.float32)
        asked[column[column >= 0]] = 1
        tokens = tokens[column < 0]
        at = W.ragged(self.begins[tokens], self.ends[tokens] - self.begins[tokens])
        rare = np.bincount(self.posting_doc[at], self.posting_weight[at], minlength=len(self.matrix))
        return rare + self.matrix @ asked

    @staticmethod
    def nearest(score: np.ndarray, unused: np.ndarray, most: int) -> list[int]:
        found = np.flatnonzero(unused & (score > 0))
        if len(found) > most:
            least = -np.partition(-score[found], most - 1)[most - 1]
            found = found[score[found] >= least]  # ties at the cut too
        return found[np.lexsort((found, -score[found]))][:most].tolist()


def pack_shard(n: np.ndarray, index: Index, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length)."""
    unused = np.ones(len(n), dtype=bool)
    size = n.tolist()
    sequences, pieces, free = [], [], window
    carry, upto = None, 0
    while True:
        if carry is None:
            while upto < len(size) and not unused[upto]:
                upto += 1
            if upto == len(size):
                break
            carry = upto, 0
            unused[upto] = False
        seed, start = carry
        take = min(size[seed] - start, free)
        pieces.append((seed, start, take))
        free -= take
        carry = (seed, start + take) if start + take < size[seed] else None
        if free and unused.any():
            score, cut, most = index.scores(seed), None, NEIGHBOURS
            while free and cut is None:
                near = index.nearest(score, unused, most)
                most *= 2
                for d in near:
                    if size[d] <= free:
                        pieces.append((d, 0, size[d]))
                        unused[d] = False
                        free -= size[d]
                    elif cut is None:
                        cut = d
                if not near:
                    break
            if free and cut is not None:
                pieces.append((cut, 0, free))
                unused[cut] = False
                carry = cut, free
                free = 0
        if not free:
            sequences.append(pieces)
            pieces, free = [], window
    if pieces:
        sequences += powers(pieces, window - free)
    return sequences


def powers(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """Cut pieces of ``total`` tokens into sequences of a power of two each."""
    out, at = [], 0
    left = list(pieces)
    for bit in reversed(range(total.bit_length())):
        room = total & (1 << bit)
        if not room:
            continue
        now = []
        while room:
            doc, start, length = left[at]
            take = min(length, room)
            now.append((doc, start, take))
            room -= take
            if take == length:
                at += 1
            else:
                left[at] = doc, start + take, length - take
        out.append(now)
    return out


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, ids binary")


def _pack(idf: np.ndarray, mean: float, dtype: np.dtype, window: int):
    def packed(shard, keys, ids):
        n = np.array([len(x) // dtype.itemsize for x in ids])
        flat = np.frombuffer(b"".join(ids), dtype=dtype)
        begins = np.cumsum(n) - n
        sequences = pack_shard(n, Index(flat, n, idf, mean), window)
        wide = flat.astype("<u4")
        out: tuple[list, ...] = ([], [], [], [], [], [], [], [])
        for s, pieces in enumerate(sequences):
            offset = 0
            for doc, start, length in pieces:
                a = begins[doc] + start
                row = (keys[doc], start, length, zlib.crc32(wide[a:a + length]), int(n[doc]),
                       (shard << 32) + s, offset, flat[a:a + length].tobytes())
                for column, x in zip(out, row):
                    column.append(x)
                offset += length
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in out[:7]), pa.array(out[7], pa.binary())], names)

    def run(batches):
        forget_words()
        now, keys, ids = None, [], []
        for batch in batches:
            for shard, key, own in zip(batch.column("shard").to_pylist(),
                                       batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                if shard != now and ids:
                    yield packed(now, keys, ids)
                    keys, ids = [], []
                now = shard
                keys.append(key)
                ids.append(own)
        if ids:
            yield packed(now, keys, ids)
    return run


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length,
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers),
    doc_tokens, sequence_id, offset and ids (little-endian, 16 bits each if
    the vocabulary allows, else 32).

    A document is its text's ids by the ``tokenizer`` file, without special
    tokens added, then id 1; a null or empty text is id 1 alone. Each id is in
    exactly one piece. Sequences hold ``window`` ids or a power of two. Rows
    are packed each, also those that repeat or have a null id. Documents of
    any length are cut. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = word_ids(tokenizer)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text"))
    tokens = stored(rows.mapInArrow(_tokenize(tokenizer), TOKENS), "tokens")
    texts = tokens.filter("ids is not null")
    total, held = texts.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(known.size, dtype=np.int64)
    for r in tokens.filter("token is not null").groupBy("token").agg(F.sum("df").alias("df")).collect():
        df[r["token"]] = r["df"]  # one row per id of the vocabulary
    idf = np.log1p((total - df + 0.5) / (df + 0.5)).astype(np.float32)

    bucket = F.pmod("rarest", F.lit(BUCKETS))
    sizes = {r["bucket"]: r["n"] for r in texts.groupBy(bucket.alias("bucket"))
             .agg(F.sum("n").alias("n")).collect()}  # BUCKETS rows at the most
    plan, shard, room = [], -1, 0
    for b in sorted(sizes):
        parts = -(-sizes[b] // shard_tokens)
        if parts > 1:
            plan.append((b, shard + 1, parts))
            shard, room = shard + parts, 0
        else:
            if sizes[b] > room:
                shard, room = shard + 1, shard_tokens
            plan.append((b, shard, 1))
            room -= sizes[b]
    plan_rows = spark.createDataFrame(plan, "bucket int, first long, parts long")
    # rows that repeat an id and text differ by their place in the stored tokens
    placed = texts.withColumns({"bucket": bucket, "place": F.monotonically_increasing_id()})
    sharded = (placed.join(F.broadcast(plan_rows), "bucket")
               .select((F.col("first") + F.pmod(F.xxhash64("doc_id", "text_hash", "place"), "parts")).alias("shard"),
                       "doc_id", "text_hash", "ids"))
    return (sharded.repartition(shuffle_width(spark), "shard")
            .sortWithinPartitions("shard", "doc_id", "text_hash").drop("text_hash")
            .mapInArrow(_pack(idf, (held or 0) / max(total, 1), known.dtype, window), PIECES))
