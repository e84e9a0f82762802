"""Dense text features, computed a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import words as W

# Byte classes of UTF-8 text.
CLASSES = {
    "lower": range(ord("a"), ord("z") + 1),
    "upper": range(ord("A"), ord("Z") + 1),
    "digit": range(ord("0"), ord("9") + 1),
    "stop": b".,;:'\"-()",
    "shout": b"!?",
    "symbol": b"#$%&*+/<=>@[\\]^_`{|}~",
    "line": b"\n",
    "blank": b" \t\r\x0b\x0c",
    "high": range(128, 256),
}


def byte_counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, class) counts in the order of ``CLASSES``, and byte lengths."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = (np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None
            else np.zeros(0, dtype=np.uint8))
    bounds = offsets - offsets[0]
    table = np.full(256, len(CLASSES), dtype=np.uint8)
    for i, members in enumerate(CLASSES.values()):
        table[list(members)] = i
    kind = table[data]
    out = np.zeros((len(texts), len(CLASSES)), dtype=np.float64)
    for i in range(len(CLASSES)):
        at = np.flatnonzero(kind == i)
        out[:, i] = np.searchsorted(at, bounds[1:]) - np.searchsorted(at, bounds[:-1])
    return out, np.diff(bounds).astype(np.float64)


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each text's values (a text may have none)."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def distinct_share(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: distinct words, and the share of its commonest word."""
    n = np.diff(w.bounds)
    pairs = np.sort((np.repeat(np.arange(len(n), dtype=np.int64), n) << 32) | w.codes)
    new = np.ones(len(pairs), dtype=bool)
    new[1:] = pairs[1:] != pairs[:-1]
    first = np.flatnonzero(new)
    distinct = np.bincount(pairs[first] >> 32, minlength=len(n)).astype(np.float64)
    most = np.zeros(len(n))
    np.maximum.at(most, pairs[first] >> 32, np.diff(np.append(first, len(pairs))).astype(np.float64))
    return distinct, most / np.maximum(n, 1)


def word_lengths(w: W.Words) -> np.ndarray:
    return pc.binary_length(w.vocab).to_numpy(zero_copy_only=False)[w.codes].astype(np.float64)
