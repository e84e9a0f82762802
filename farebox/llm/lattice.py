"""SentencePiece encoding by forward filtering and backward sampling, and
decoding (operator 1).

A text's lattice holds every piece that spells a stretch of it. Forward
filtering sums the weight of all ways to reach each position; backward
sampling walks from the end and draws each piece in proportion to its share of
what reaches its end, so a segmentation is drawn with exactly its
probability. A piece's weight follows Zipf's law over its rank in the
vocabulary, to the power ``alpha``: a larger one favours common pieces.

No piece of such a vocabulary goes on beyond a word's end (this is checked when
the model is opened), so the lattice falls into words. Each distinct word of a batch is
filtered once; all its occurrences draw from it at the same time. Draws are a
hash of (seed, row key, word, step): the same row gives the same pieces on any
cluster, in any batch, after any retry.

Decoding is lossless: spaces travel as the word mark, characters without a
piece (and the word mark itself, if a text holds it) as bytes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .runtime import prepare

ALPHA = 1.0
ZIPF_SHIFT = 2.7
SEED = 42
CHUNK_BYTES = 2 << 20
MARK = "▁"          # the word mark of SentencePiece
STEP = np.uint64(0xD1342543DE82EF95)
BITS = 20                # of the table that most substrings fail


class Model:
    """Pieces of a SentencePiece BPE model with byte fallback, as arrays."""

    _open: dict[str, "Model"] = {}

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)
                                                or sp.is_unused(i))]
        if any(MARK in pieces[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece goes on beyond a word's end")
        self.size = size
        self.bytes = np.zeros(256, dtype=np.int64)
        for i in range(size):
            if sp.is_byte(i):
                self.bytes[int(pieces[i][3:5], 16)] = i
        rank = np.array([-sp.get_score(i) for i in plain])
        weight = -alpha * np.log(ZIPF_SHIFT + rank)
        weight -= np.log(np.exp(weight).sum())
        self.unknown = weight.min()  # log-weight of a byte
        self.longest = max(len(pieces[i]) for i in plain)
        # By length: sorted hashes of the pieces' characters, ids, log-weights,
        # and a bit set of the hashes of all beginnings of that length.
        begins: list[set[str]] = [set() for _ in range(self.longest + 1)]
        for i in plain:
            for n in range(1, len(pieces[i]) + 1):
                begins[n].add(pieces[i][:n])
        self.table = []
        for n in range(1, self.longest + 1):
            own = [k for k, i in enumerate(plain) if len(pieces[i]) == n]
            chars = np.array([[ord(c) for c in pieces[plain[k]]] for k in own], dtype=np.uint64).reshape(-1, n)
            h = self.spell(chars)
            by = np.argsort(h)
            ids = np.array([plain[k] for k in own], dtype=np.int64)[by]
            known = np.zeros(1 << BITS, dtype=bool)
            known[self.slot(self.spell(np.array([[ord(c) for c in x] for x in sorted(begins[n])],
                                                dtype=np.uint64).reshape(-1, n)))] = True
            self.table.append((h[by], ids, weight[own][by], chars[by], known))
        # Decoding: each id's bytes.
        spelt = [bytes([int(pieces[i][3:5], 16)]) if sp.is_byte(i) else pieces[i].replace(MARK, " ").encode()
                 if not (sp.is_control(i) or sp.is_unknown(i)) else b"" for i in range(size)]
        self.length = np.array([len(s) for s in spelt], dtype=np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(spelt), dtype=np.uint8)
        split = set(" \n") - {c for i in plain for c in pieces[i]}  # "\n", if no piece holds it
        self.words = re.compile(r" *[^ \n]+|\n| +" if "\n" in split else r" *[^ ]+| +")

    @staticmethod
    def spell(chars: np.ndarray) -> np.ndarray:
        h = np.zeros(len(chars), dtype=np.uint64)
        for j in range(chars.shape[1]):
            h = h * W.BASE + chars[:, j] + np.uint64(1)
        return h

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        """Place in a bit set: the high bits of one more multiplication."""
        return ((h * W.BASE) >> np.uint64(64 - BITS)).astype(np.int64)

    @classmethod
    def at(cls, path: str, alpha: float) -> "Model":
        key = f"{path}|{alpha}"
        if key not in cls._open:
            cls._open[key] = cls(path, alpha)
        return cls._open[key]

    def chars(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code points as the lattice sees them, the true ones, word bounds):
        a space is the word mark; a word mark in the text is beyond all
        characters, so that no piece matches it."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        true = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        seen = true.astype(np.uint64)
        seen[true == ord(MARK)] = 0x110000
        seen[true == ord(" ")] = ord(MARK)
        return seen, true, np.concatenate([[0], np.cumsum(size)])


class Lattice:
    """Filtered lattices of distinct words. A state is a position of a word;
    states are numbered by position first, so that one sort of the edges by
    their end gives both the order of the forward pass and the table that
    sampling searches."""

    def __init__(self, model: Model, words: list[str]):
        seen, true, bounds = model.chars(words)
        size = np.diff(bounds)
        # Longest words first: those that reach position j are the first ones.
        kind = np.int32 if len(seen) + len(words) < 1 << 31 else np.int64
        rank = np.empty(len(words), dtype=kind)
        rank[np.argsort(-size, kind="stable")] = np.arange(len(words))
        longest = int(size.max(initial=0))
        reach = len(words) - np.cumsum(np.bincount(size, minlength=longest + 1)) + np.bincount(
            size, minlength=longest + 1)  # words of at least j characters
        states = int(reach.sum())
        base = (np.cumsum(reach) - reach).astype(kind)  # first state of position j
        n = len(seen)
        place = (np.arange(n) - np.repeat(bounds[:-1], size)).astype(kind)
        left = (np.repeat(bounds[1:], size) - np.arange(n)).astype(kind)
        own_rank = np.repeat(rank, size)
        starts, ends, ids, logs = [], [], [], []
        single = np.zeros(n, dtype=bool)
        at = np.arange(n)
        h = np.zeros(n, dtype=np.uint64)
        for length in range(1, model.longest + 1):
            inside = left[at] >= length
            if not inside.all():
                at, h = at[inside], h[inside]
            h = h * W.BASE + seen[at + (length - 1)] + np.uint64(1)
            keys, own, weight, chars, known = model.table[length - 1]
            go = known[model.slot(h)]  # no piece goes on from here otherwise
            at, h = at[go], h[go]
            if not len(at):
                break
            if not len(keys):
                continue
            k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[k] == h
            found, k = at[hit], k[hit]
            for j in range(length):
                same = seen[found + j] == chars[k, j]
                if not same.all():
                    found, k = found[same], k[same]
            if length == 1:
                single[found] = True
            first = place[found]
            starts.append(base[first] + own_rank[found])
            ends.append(base[first + length] + own_rank[found])
            ids.append(own[k].astype(kind))
            logs.append(weight[k])
        # Characters without a piece: their bytes, named by size + place.
        lost = np.flatnonzero(~single)
        self.lost_bytes = [chr(c).encode("utf-8", "surrogatepass") for c in true[lost].tolist()]
        starts.append(base[place[lost]] + own_rank[lost])
        ends.append(base[place[lost] + 1] + own_rank[lost])
        ids.append((model.size + np.arange(len(lost))).astype(kind))
        logs.append(np.array([len(b) for b in self.lost_bytes], dtype=np.float64) * model.unknown)
        end = np.concatenate(ends)
        packed = np.sort((end.astype(np.uint64) << np.uint64(32)) | np.arange(len(end), dtype=np.uint64))
        by = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)
        end = end[by]
        self.start, self.piece = np.concatenate(starts)[by], np.concatenate(ids)[by]
        log = np.concatenate(logs)[by]
        self.first, self.last = rank, base[size] + rank

        # Forward, all words at once, position by position; a state's edges
        # are neighbours.
        head = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]])) if len(end) else by
        count = np.diff(np.append(head, len(end)))
        alpha = np.zeros(states)
        share = np.empty(len(end))
        level = np.searchsorted(end[head], np.append(base[1:], len(alpha)))
        edges = np.append(head, len(end))
        for i, j in zip(level[:-1], level[1:]):
            if i == j:
                continue
            a, b = edges[i], edges[j]
            value = alpha[self.start[a:b]] + log[a:b]
            own = head[i:j] - a
            top = np.maximum.reduceat(value, own)
            part = np.exp(value - np.repeat(top, count[i:j]))
            sums = np.add.reduceat(part, own)
            alpha[end[head[i:j]]] = top + np.log(sums)
            share[a:b] = part / np.repeat(sums, count[i:j])
        upto = np.cumsum(share)
        before = np.repeat((upto - share)[head], count)
        self.key = end + np.minimum(upto - before, 1.0)
        tail = edges[1:] - 1
        self.key[tail] = end[tail] + 1.0

    def sample(self, code: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces in order, number of pieces of each occurrence) of the words
        ``code``, drawn with the random stream ``key`` of each."""
        state = self.last[code]
        goal = self.first[code]
        active = np.flatnonzero(state > goal)
        steps, count = [], np.zeros(len(code), dtype=np.int64)
        t = 0
        while len(active):
            # 24 bits, so that state + u is exact
            u = (W.mix(key[active] + np.array([t], dtype=np.uint64) * STEP) >> np.uint64(40)) * 2.0 ** -24
            edge = np.searchsorted(self.key, state[active] + u, side="right")
            steps.append((active, self.piece[edge]))
            state[active] = self.start[edge]
            count[active] += 1
            active = active[state[active] > goal[active]]
            t += 1
        ends = np.cumsum(count)
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        for t, (who, piece) in enumerate(steps):
            out[ends[who] - 1 - t] = piece
        return out, count


def encode(model: Model, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each). ``keys``: one 64-bit random
    key per text. An empty text has no id."""
    known: dict[str, int] = {}
    codes, counts = [], []
    for text in texts:
        parts = model.words.findall(" " + text) if text else []
        codes += [known.setdefault(p, len(known)) for p in parts]
        counts.append(len(parts))
    counts = np.array(counts, dtype=np.int64)
    code = np.array(codes, dtype=np.int64)
    nth = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts)
    key = W.mix(np.repeat(keys, counts) + W.mix(nth.astype(np.uint64)))
    lattice = Lattice(model, list(known))
    pieces, per_word = lattice.sample(code, key)
    size = np.ones(len(pieces), dtype=np.int64)
    lost = np.flatnonzero(pieces >= model.size)
    if len(lost):
        spelt = np.array([len(b) for b in lattice.lost_bytes], dtype=np.int64)
        flat = model.bytes[np.frombuffer(b"".join(lattice.lost_bytes), dtype=np.uint8)]
        which = pieces[lost] - model.size
        size[lost] = spelt[which]
        ids = np.repeat(pieces, size)
        begin = np.cumsum(size) - size
        ids[W.ragged(begin[lost], size[lost])] = flat[W.ragged((np.cumsum(spelt) - spelt)[which], spelt[which])]
    else:
        ids = pieces
    upto = np.concatenate([[0], np.cumsum(size)])
    word_ends = np.concatenate([[0], np.cumsum(per_word)])
    text_ends = word_ends[np.concatenate([[0], np.cumsum(counts)])]
    return ids, np.diff(upto[text_ends])


def decode(model: Model, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The UTF-8 text of each run of ``counts`` ids."""
    size = model.length[ids]
    raw = model.blob[W.ragged(model.begin[ids], size)].tobytes()
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    # the first byte is the mark that encoding puts before a text
    return [raw[a + 1:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _encode(path: str, alpha: float, seed: int, back: bool):
    def run(batches):
        model = Model.at(path, alpha)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            rows = batch.column(batch.num_columns - 2).to_numpy().view(np.uint64)
            keys = W.mix(rows ^ W.mix(np.array([seed], dtype=np.uint64)))
            for a, n in W.chunks(column, CHUNK_BYTES):
                texts = [x or "" for x in column.slice(a, n).to_pylist()]
                ids, counts = encode(model, texts, keys[a:a + n])
                ends = np.concatenate([[0], np.cumsum(counts)]) * 2
                raw = ids.astype("<u2").tobytes()
                out = [pa.array(counts), pa.array([raw[p:q] for p, q in zip(ends[:-1].tolist(), ends[1:].tolist())],
                                                  pa.binary())]
                if back:
                    out.append(pa.array(decode(model, ids, counts), pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, n) for i in range(batch.num_columns - 2)), *out],
                    [f"c{i}" for i in range(batch.num_columns - 2 + len(out))])
    return run


def sample_pieces(docs: DataFrame, model: str, alpha: float = ALPHA, seed: int = SEED,
                  id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """(doc_id, n_pieces, ids): one sampled segmentation of each row; ids are
    little-endian unsigned 16-bit integers of the model's vocabulary. With
    ``back``, also ``text``: what the ids spell, decoded in the same task.

    The row key is the id; rows of one id and text draw alike, a null id is a
    key of its own. Null and empty texts have no pieces. White space, control
    and unknown characters come back as they were.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("c0"), F.xxhash64(F.lit("row"), F.col(id_col)).alias("key"),
                       F.col(text_col).cast("string").alias("text"))
    fields = [rows.schema["c0"], T.StructField("c1", T.LongType()), T.StructField("c2", T.BinaryType())]
    names = ["doc_id", "n_pieces", "ids"]
    if back:
        fields.append(T.StructField("c3", T.StringType()))
        names.append("text")
    return rows.mapInArrow(_encode(model, alpha, seed, back), T.StructType(fields)).toDF(*names)


def _decode(path: str):
    def run(batches):
        model = Model.at(path, ALPHA)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for a, n in W.chunks(column, CHUNK_BYTES):
                own = column.slice(a, n).to_pylist()
                ids = np.frombuffer(b"".join(own), dtype="<u2").astype(np.int64)
                counts = np.array([len(x) // 2 for x in own], dtype=np.int64)
                texts = pa.array(decode(model, ids, counts), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, n) for i in range(batch.num_columns)), texts],
                    [f"c{i}" for i in range(batch.num_columns + 1)])
    return run


def decode_pieces(pieces: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``pieces`` and ``text``, the text that the ids spell (a former ``text`` is
    replaced); no ids spell the empty text."""
    prepare(pieces.sparkSession)
    names = pieces.drop("text").columns
    rows = pieces.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)),
                         F.coalesce(F.col(ids_col), F.lit(b"")).alias(f"c{len(names)}"))
    schema = T.StructType([*rows.schema.fields, T.StructField(f"c{len(names) + 1}", T.StringType())])
    return rows.mapInArrow(_decode(model), schema).drop(f"c{len(names)}").toDF(*names, "text")
