"""Operators 5, 8 and 9 against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from farebox.llm import simhash, suffixes, superkmers
from farebox.llm import words as W

from .conftest import EDGE_ROWS, PASSAGE, prose

LOW = -(1 << 63)


def windows(rows, width):
    """[(id, words)], {content: [(id, start)]} with null ids first."""
    own = [(LOW if i is None else i, (t or "").encode().split()) for i, t in rows]
    places = {}
    for i, w in own:
        for k in range(len(w) - width + 1):
            places.setdefault(tuple(w[k:k + width]), []).append((i, k))
    return own, places


def brute_removed(rows, width=20):
    own, places = windows(rows, width)
    first = {c: min(p) for c, p in places.items()}
    out = []
    for (i, w), (doc, _) in zip(own, rows):
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < (i, k):
                gone.update(range(k, k + width))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc, len(w), len(gone), kept.decode()))
    return out


def brute_passages(rows, length):
    own, places = windows(rows, length)
    out = set()
    for (i, w), (doc, _) in zip(own, rows):
        held, late = set(), set()
        for k in range(len(w) - length + 1):
            p = places[tuple(w[k:k + length])]
            if set(p) != {(i, k)}:
                held.update(range(k, k + length))
                if min(p) < (i, k):
                    late.update(range(k, k + length))
        spots = sorted(held)
        for k in spots:
            if k - 1 not in held:
                end = next(e for e in range(k, len(w) + 1) if e not in held)
                out.add((doc, k, end - k, len(late & set(range(k, end)))))
    return out


def brute_components(rows, most=3):
    prints = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[a:a + 3]) for a in range(len(w) - 2)] if len(w) > 2 else ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= most and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [(i, f"{p:016x}", least.get(g)) for (i, _), p, g in zip(rows, prints, group)]


def key(x):
    return tuple((v is None, v if v is not None else 0) for v in x)


def removed(df, **kw):
    out = superkmers.remove_repeated_words(df, **kw)
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()), key=key)


def found(df):
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("f")
    return sorted(map(tuple, simhash.near_duplicates(df).select("doc_id", hexed, "component_id").collect()), key=key)


def sample_rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


def test_words_are_split_at_ascii_space_only():
    import pyarrow as pa

    texts = ["a b  a\x0bb\x1c c d", None, "", "  x ", "a\r\nb\x0cq\tz"]
    w = W.encode(pa.array(texts))
    v = w.vocab.to_pylist()
    assert [[v[c] for c in w.codes[a:b]] for a, b in zip(w.bounds, w.bounds[1:])] == [
        (t or "").encode().split() for t in texts]


def test_equal_windows_survive_hash_collisions():
    codes = np.array([1, 2, 3, 1, 2, 3, 1, 2, 4], dtype=np.int32)
    starts = np.arange(7)
    order = np.arange(7)
    honest = W.equal_windows(W.window_hash(codes.astype(np.uint64), 3), codes, starts, 3, order)
    forced = W.equal_windows(np.zeros(7, dtype=np.uint64), codes, starts, 3, order)
    for dup, head in (honest, forced):
        pairs = {(int(dup[h]), int(x)) for x, h in zip(dup, head)}
        assert pairs == {(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)}


def test_super_kmers_on_edge_rows(edge, nothing):
    assert removed(edge) == sorted(brute_removed(EDGE_ROWS), key=key)
    out = superkmers.remove_repeated_words(edge)
    assert out.count() == len(EDGE_ROWS) and "version" in out.columns
    assert superkmers.remove_repeated_words(nothing).count() == 0


def test_super_kmers_on_documents(documents):
    assert removed(documents) == sorted(brute_removed(sample_rows(documents)), key=key)


def test_super_kmers_in_small_chunks_and_hot_minimisers(documents, monkeypatch):
    """Passages of one chunk and across chunks; every minimiser split."""
    monkeypatch.setattr(superkmers, "CHUNK_BYTES", 1 << 14)
    monkeypatch.setattr(superkmers, "_frequent", lambda docs, total, width, gram, share: np.sort(
        np.unique(np.concatenate([superkmers._minimisers(W.hash_words(w.vocab)[w.codes], width, gram)[0]
                                  for w in [_encoded(docs)]]))))
    assert removed(documents.limit(60)) == sorted(brute_removed(sample_rows(documents.limit(60))), key=key)


def test_texts_of_one_id_whose_hashes_agree_in_32_bits(spark):
    """A text that repeats itself and one of a single word, under a null id and
    under one id: 32 bits of the hash do not tell them apart."""
    def low(t):
        return xxhash.xxh64_intdigest(t, seed=42) & 0xFFFFFFFF
    short = {low(f"s{k}"): f"s{k}" for k in range(1 << 17)}
    long = next(t for t in (f"{PASSAGE} {PASSAGE} t{k}" for k in range(1 << 20)) if low(t) in short)
    rows = [(i, t) for i in (None, 5) for t in (long, short[low(long)])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(df) == sorted(brute_removed(rows), key=key)
    assert {tuple(r) for r in suffixes.repeated_passages(df).collect()} == brute_passages(rows, 50)


def _encoded(docs):
    import pyarrow as pa

    return W.encode(pa.array([" ".join(r["text"] for r in docs.collect())]))


def test_sparse_suffixes(edge, nothing, documents):
    for df, rows in ((edge, EDGE_ROWS), (documents, sample_rows(documents))):
        got = [tuple(r) for r in suffixes.repeated_passages(df).collect()]
        assert len(got) == len(set(got))
        assert set(got) == brute_passages(rows, 50)
    assert suffixes.repeated_passages(nothing).count() == 0
    hit = {r["doc_id"] for r in suffixes.repeated_passages(edge).collect()}
    assert {9, 10, 11, 12} <= hit and not {4, 5, 14} & hit


def test_simhash(edge, nothing, documents):
    for df, rows in ((edge, EDGE_ROWS), (documents, sample_rows(documents))):
        assert found(df) == sorted(brute_components(rows), key=key)
    assert simhash.near_duplicates(nothing).count() == 0


def test_simhash_links_near_prints_across_tiles(spark):
    """Chains of small steps and dense groups, in blocks of two."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 12).astype(np.uint64)
    fps = [int(b) for b in base]
    for b in base[:6]:
        x = int(b)
        for _ in range(12):
            for bit in rng.choice(64, rng.integers(1, 4), replace=False):
                x ^= 1 << int(bit)
            fps.append(x)
    fps = sorted(set(fps))
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), block=2).collect()
    group = {s[0]: s[0] for s in signed}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for r in edges:
        assert ((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= 3
        group[root(r["a"])] = root(r["b"])
    for (a,), x in zip(signed, fps):
        for (b,), y in zip(signed, fps):
            if (x ^ y).bit_count() <= 3:
                assert root(a) == root(b)


def test_majority_of_long_documents():
    h = np.random.default_rng(1).integers(0, 1 << 63, 70_000).astype(np.uint64)
    got = simhash.majority(h, np.array([0, 69_999, 1]))
    bits = (h[:69_999, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    want = sum(1 << b for b in range(64) if 2 * int(bits[:, b].sum()) > 69_999)
    assert [int(x) for x in got] == [0, want, int(h[-1])]


@pytest.mark.parametrize("copies", [40])
def test_hot_groups(spark, copies):
    rows = [(i, prose(1, 60)) for i in range(copies)] + [(copies + i, PASSAGE + " " + prose(10 + i, 30))
                                                         for i in range(copies)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert removed(df) == sorted(brute_removed(rows), key=key)
    assert {tuple(r) for r in suffixes.repeated_passages(df).collect()} == brute_passages(rows, 50)


def most_in_a_bucket(blocks):
    """(runs in the fullest bucket, all runs)."""
    import zstandard

    unzip, n = zstandard.ZstdDecompressor(), {}
    for r in blocks.filter("codes is not null").collect():
        n[r["bucket"]] = n.get(r["bucket"], 0) + int(superkmers.read_places(r["runs"], unzip)["n"].sum())
    return max(n.values()), sum(n.values())


def test_sparse_suffixes_deal_out_a_hot_gram(spark, monkeypatch):
    """One gram in every document, each time between other words; some windows
    around it repeat, most do not."""
    import pyarrow as pa

    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 1 << 12)
    def rank(text):  # as a minimiser
        w = W.encode(pa.array([text]))
        return W.mix(W.window_hash(W.hash_words(w.vocab)[w.codes], 24))[0]
    core = min((prose(k, 24) for k in range(5000, 5300)), key=rank)
    rows = [(i, f"{prose(1000 + i, 40)} {core} {prose(2000 + i % 90, 40)}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {tuple(r) for r in suffixes.repeated_passages(df).collect()} == brute_passages(rows, 50)
    suffixes.prepare(spark)
    blocks, buckets = suffixes._blocks(superkmers.keyed(df, "doc_id", "text"), 50, 24)
    most, total = most_in_a_bucket(blocks)
    assert buckets > 8 and total > 1000 and most < total / 4, (buckets, total, most)


def test_super_kmers_deal_out_a_hot_pair(spark, monkeypatch):
    """One passage in every document, both minimisers of most windows inside it."""
    monkeypatch.setattr(superkmers, "BUCKET_BYTES", 1 << 11)
    core = min((prose(k, 8) for k in range(5000, 5300)),
               key=lambda t: _both_ranks(t.encode().split()))
    rows = [(i, f"{prose(1000 + i, 15)} {core} {prose(2000 + i % 90, 15)}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removed(df) == sorted(brute_removed(rows), key=key)
    blocks, buckets = superkmers._blocks(superkmers.keyed(df, "doc_id", "text"), 20, 4)
    most, total = most_in_a_bucket(blocks)
    assert buckets > 8 and most < total / 6, (buckets, most, total)


def _both_ranks(words):
    import pyarrow as pa

    grams = W.mix(W.window_hash(W.hash_words(pa.array(words, pa.large_binary())), 4))
    return max(int(grams.min()), int(W.mix(grams).min()))
