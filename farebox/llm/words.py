"""Vectorised word arithmetic on Arrow text columns.

A word is a run of bytes other than space and \\x09-\\x0D. ``encode`` turns a
text column into integer codes over the batch's own vocabulary; the helpers
below hash and minimise windows of consecutive codes with numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Odd 64-bit multiplier of the polynomial window hash.
BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """``codes[bounds[i]:bounds[i+1]]`` are the words of text i."""

    codes: np.ndarray   # int32, one per word
    bounds: np.ndarray  # int64, texts + 1
    vocab: pa.Array     # binary, by code


def encode(texts: pa.Array) -> Words:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    lists = pc.ascii_split_whitespace(texts)
    values = lists.flatten()
    full = pc.greater(pc.binary_length(values), 0)
    kept = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(full.to_numpy(zero_copy_only=False), out=kept[1:])
    offsets = lists.offsets.to_numpy()
    bounds = kept[offsets - offsets[0]]
    coded = values.filter(full).dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int32, copy=False),
                 bounds, coded.dictionary.cast(pa.large_binary()))


def hash_words(vocab: pa.Array, seed: int = 0) -> np.ndarray:
    """XXH64 of each word of a vocabulary."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in vocab.to_pylist()), dtype=np.uint64,
                       count=len(vocab))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): a fresh pseudo-random order."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(BASE), exponent, 1 << 64))


def window_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive entries (mod 2^64), by
    doubling. Windows that cross a text's end are the caller's to leave out."""
    if len(h) < width:
        return np.zeros(0, dtype=np.uint64)
    have, size, out, done = h, 1, None, 0
    while True:
        if width & size:
            if out is None:
                out, done = have, size
            else:  # out covers `done` entries, followed by `size` more
                n = len(h) - done - size + 1
                out = out[:n] * power(size) + have[done:done + n]
                done += size
        size *= 2
        if size > width:
            return out
        n = len(h) - size + 1
        have = have[:n] * power(size // 2) + have[size // 2:size // 2 + n]


def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries."""
    if len(x) < width:
        return x[:0]
    have, size = x, 1
    while size * 2 <= width:
        have = np.minimum(have[:-size], have[size:])
        size *= 2
    if size < width:
        have = np.minimum(have[:len(x) - width + 1], have[width - size:])
    return have


def starts_inside(bounds: np.ndarray, width: int) -> np.ndarray:
    """Boolean per word: a window of ``width`` words starts here."""
    n = int(bounds[-1])
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)
    return left >= width


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, .. of each (start, length), concatenated."""
    lengths = np.asarray(lengths, dtype=np.int64)
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(np.asarray(starts, dtype=np.int64) - (ends - lengths),
                                        lengths)


def equal_windows(hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray, width: int,
                  order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact grouping of the windows ``codes[starts[i]:starts[i]+width]``.

    Returns (dup, head): the windows whose content occurs more than once,
    sorted by content and then by ``order``, and for each the index in
    ``dup`` of the first of its group. Sorting by hash only brings equal
    windows together; neighbours are compared word by word, and if a hash
    holds different contents, the words themselves are the sort key.
    """
    n = len(hashes)
    none = np.zeros(0, dtype=np.int64)
    if n < 2:
        return none, none
    # Row numbers in the low bits: one fast sort of plain integers brings
    # together the windows that agree in the hash's high bits.
    low = np.uint64((1 << int(n - 1).bit_length()) - 1)
    packed = np.sort((hashes & ~low) | np.arange(n, dtype=np.uint64))
    high = packed & ~low
    near = high[1:] == high[:-1]
    in_run = np.zeros(n, dtype=bool)
    in_run[1:] = near
    in_run[:-1] |= near
    some = (packed[in_run] & low).astype(np.int64)
    del packed, high, near, in_run
    if not len(some):
        return none, none
    some = some[np.lexsort((order[some], hashes[some]))]
    same = hashes[some[1:]] == hashes[some[:-1]]
    at = np.flatnonzero(same)
    left, right = starts[some[at]], starts[some[at + 1]]
    if any((codes[left + k] != codes[right + k]).any() for k in range(width)):
        words = [codes[starts[some] + k] for k in reversed(range(width))]
        some = some[np.lexsort((order[some], *words))]
        same = np.ones(len(some) - 1, dtype=bool)
        for k in range(width):
            w = codes[starts[some] + k]
            same &= w[1:] == w[:-1]
    again = np.zeros(len(some), dtype=bool)
    again[1:] = same
    group = again.copy()
    group[:-1] |= same
    dup, again = some[group], again[group]
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(dup))))
    return dup, head


def runs_of(starts: np.ndarray, doc: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of consecutive ``starts`` of one ``doc`` with equal keys:
    (index of the first, length)."""
    n = len(starts)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    cut = np.ones(n, dtype=bool)
    cut[1:] = (starts[1:] != starts[:-1] + 1) | (doc[1:] != doc[:-1])
    for k in keys:
        cut[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(cut)
    return first, np.diff(np.append(first, n))


def chunks(texts: pa.Array, limit: int):
    """(offset, length) slices of a text column of about ``limit`` bytes; a
    longer text is a slice of its own."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    a = 0
    while a < len(ends):
        base = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield a, b - a
        a = b
