"""SimHash near-duplicates with a pigeonring filter (operator 5).

A 64-bit fingerprint is cut into ``SEGMENTS`` = 4 segments on a ring. If two
fingerprints differ in at most 3 bits, then from some segment on, every
chain of l consecutive segments holds at most l * 3 / 4 differences, rounded
down: 0 in the first, 1 in the first two, 2 in the first three, 3 in all. The
first budget makes a segment equal, the second one makes one half of the next
segment equal, so candidates meet on keys of 16 + 8 bits (4 starts x 2
halves). The chain budgets prune them before the full Hamming check.

Equal fingerprints are one node, so a group of exact copies costs one row.
Within a key, a search from node to node emits one link per node reached (a
spanning forest), never all pairs. A key with more than ``BLOCK`` nodes is cut
into blocks, and pairs of blocks are tasks of bounded size.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .runtime import prepare, shuffle_width, stored

SHINGLE = 3
MAX_BITS = 3
SEGMENTS = 4
SEED = 42
BLOCK = 2048
CHUNK_WORDS = 1 << 20

# Byte value -> counts of its 8 bits, in 16-bit lanes of two integers.
_LANES = np.zeros((2, 256), dtype=np.uint64)
for _v, _bit in itertools.product(range(256), range(8)):
    if _v >> _bit & 1:
        _LANES[_bit // 4, _v] += np.uint64(1 << 16 * (_bit % 4))


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each document from its shingle hashes (concatenated,
    ``counts`` to a document): a bit is set if over half of them set it."""
    out = np.zeros(len(counts), dtype=np.uint64)
    has = np.flatnonzero(counts)
    if not len(has):
        return out
    # Lanes overflow beyond 65535: long documents are summed in pieces.
    piece = 1 << 15
    pieces = -(-counts[has] // piece)
    ends = np.cumsum(counts[has])
    owner = np.repeat(np.arange(len(has)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    cuts = (ends - counts[has])[owner] + nth * piece
    first = np.flatnonzero(nth == 0)
    raw = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        for half in range(2):
            sums = np.add.reduceat(_LANES[half][raw[:, byte]], cuts)
            for lane in range(4):
                bits = ((sums >> np.uint64(16 * lane)) & np.uint64(0xFFFF)).astype(np.int64)
                over = 2 * np.add.reduceat(bits, first) > counts[has]
                out[has] |= over.astype(np.uint64) << np.uint64(8 * byte + 4 * half + lane)
    return out


def shingle_hashes(text: bytes, size: int) -> list[int]:
    """XXH64 (seed 42) of each run of ``size`` words of an ASCII-lower-cased
    text, joined by a space; fewer words: of the whole sequence."""
    words = text.lower().split()
    if not words:
        return []
    flat = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(flat, SEED)]
    ends = list(itertools.accumulate(map(len, words)))
    ends = [e + i for i, e in enumerate(ends)]
    begins = [0, *(e + 1 for e in ends[:-size])]
    digest = xxhash.xxh64_intdigest
    return [digest(flat[a:b], SEED) for a, b in zip(begins, ends[size - 1:])]


def _fingerprints(size: int, text_at: int):
    def run(batches):
        for batch in batches:
            prints, hashes, counts, held = [], [], [], 0
            for text in batch.column(text_at).cast(pa.large_binary()).to_pylist():
                own = shingle_hashes(text or b"", size)
                hashes.append(np.array(own, dtype=np.uint64))
                counts.append(len(own))
                held += len(own)
                if held > CHUNK_WORDS:
                    prints.append(majority(np.concatenate(hashes), np.array(counts)))
                    hashes, counts, held = [], [], 0
            if counts:
                prints.append(majority(np.concatenate(hashes), np.array(counts)))
            found = np.concatenate(prints) if prints else np.zeros(0, dtype=np.uint64)
            keys = [batch.column(i) for i in range(batch.num_columns) if i != text_at]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(found.view(np.int64))],
                                             ["doc_id", "version", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, version, fp): one row per row of ``docs``; ``version`` is a
    hash of the text that tells rows of one id apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("version"),
                       F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle, 2), "doc_id long, version long, fp long")


def _segment(i: int):
    return F.shiftrightunsigned("fp", 16 * (i % SEGMENTS)).bitwiseAND(F.lit(0xFFFF))


def ring_keys(nodes: DataFrame) -> DataFrame:
    """(key, fp): the 8 keys of each fingerprint. A key names its start
    segment, the half, and their 24 bits."""
    keys = []
    for i in range(SEGMENTS):
        for half in range(2):
            part = F.shiftrightunsigned(_segment(i + 1), 8 * half).bitwiseAND(F.lit(0xFF))
            keys.append(F.lit((i * 2 + half) << 24) + _segment(i) * 256 + part)
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "fp")


def chain_links(x: np.ndarray, others: np.ndarray, start: int, most: int) -> np.ndarray:
    """Which ``others`` are within ``most`` bits of ``x``, tried by the chain
    budgets from segment ``start`` on."""
    at = np.arange(len(others))
    diff = others ^ x
    spent = np.zeros(len(others), dtype=np.int64)
    for length in range(1, SEGMENTS + 1):
        shift = np.uint64(16 * ((start + length - 1) % SEGMENTS))
        spent = spent + np.bitwise_count((diff >> shift) & np.uint64(0xFFFF))
        ok = spent <= length * most // SEGMENTS
        at, diff, spent = at[ok], diff[ok], spent[ok]
    return at


def forest(fps: np.ndarray, start: int, most: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the nodes that share a key."""
    left, out = fps, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = chain_links(x, left, start, most)
            if len(near):
                out += [(int(x), int(y)) for y in left[near]]
                queue += list(left[near])
                left = np.delete(left, near)
    return out


def _links(most: int):
    def found(key, tile, fps):
        """Links of whole groups, sorted by key and tile."""
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1])) + 1
        out = []
        for a, b in zip([0, *cuts], [*cuts, len(key)]):
            if b - a > 1:
                out += forest(np.unique(fps[a:b]), int(key[a] >> 24) // 2, most)
        pairs = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(c.copy()) for c in pairs.T], ["a", "b"])

    def run(batches):
        key = tile = np.zeros(0, dtype=np.int64)
        fps = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy()])
            tile = np.concatenate([tile, batch.column("tile").to_numpy()])
            fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(key):
                continue
            # The last group may go on in the next batch.
            before = np.flatnonzero((key != key[-1]) | (tile != tile[-1]))
            cut = before[-1] + 1 if len(before) else 0
            if cut:
                yield found(key[:cut], tile[:cut], fps[:cut])
                key, tile, fps = key[cut:], tile[cut:], fps[cut:]
        if len(key):
            yield found(key, tile, fps)
    return run


def links(nodes: DataFrame, most: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints ``nodes.fp`` of at most
    ``most`` (3 at the most) differing bits that join what is joined by all
    such links; at most one per node and key."""
    if not 0 <= most <= MAX_BITS:
        raise ValueError(f"the keys hold for up to {MAX_BITS} bits")
    spark = nodes.sparkSession
    keys = ring_keys(nodes)
    shared = keys.groupBy("key").count().filter("count > 1")
    members = keys.join(shared, "key").withColumn("blocks", F.ceil(F.col("count") / block).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = (members.withColumn("own", own).withColumn("other", other)
             .select("key", "fp", (F.least("own", "other") * F.col("blocks").cast("long")
                                   + F.greatest("own", "other")).alias("tile")))
    n = shuffle_width(spark)
    return (tiles.repartition(n, "key", "tile").sortWithinPartitions("key", "tile")
            .mapInArrow(_links(most), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MAX_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, fp, component, component_id): rows whose fingerprints differ in
    at most ``most`` bits are linked; ``component_id`` is the smallest id
    reachable; ``component`` names the component also where all its ids are
    null.

    Fingerprints: ASCII-lower-cased words, shingles of ``shingle`` words with
    repeats, XXH64 with seed 42; a bit is set if over half of the hashes set
    it. A text of fewer words is one shingle. Empty and null texts have
    fingerprint zero and are linked like any other. Null ids count only
    where a component has no other id (component_id null). Rows are not
    linked by sharing an id.
    """
    prepare(docs.sparkSession)
    prints = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes, most)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", F.col("root").alias("component"), "component_id")
    return prints.join(classes, "fp").select("doc_id", "version", "fp", "component", "component_id")
