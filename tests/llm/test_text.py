"""Operators 1, 2 and 4 against exact round trips and brute force."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farebox.llm import lattice, packing, secret_ledger
from farebox.llm import words as W
from farebox.session import scratch_path

from .conftest import EDGE_ROWS, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------- operator 1
ODD = ["", "a", " ", "  x  y ", "hello world", "▁a ▁ b", "日本語 テスト\n\n\tx", "🙂é\x00\x1f z", "\n", " \n ", "x" * 5000]


def test_round_trip_of_odd_texts():
    model = lattice.Model.at(PIECES, 1.0)
    for seed in range(3):
        ids, counts = lattice.encode(model, ODD, W.mix(np.arange(len(ODD), dtype=np.uint64) + np.uint64(seed)))
        assert [x.decode() for x in lattice.decode(model, ids, counts)] == ODD


def test_sampled_segmentations_have_their_exact_shares():
    model = lattice.Model.at(PIECES, 1.0)
    pieces = {"".join(map(chr, c)): (int(i), w) for h, ids, weight, chars, _ in model.table
              for i, w, c in zip(ids, weight, chars)}
    word, share = "▁there", {}
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts = "".join(c + "|" * (k < len(cuts) and cuts[k]) for k, c in enumerate(word)).split("|")
        if all(p in pieces for p in parts):
            share[tuple(pieces[p][0] for p in parts)] = math.exp(sum(pieces[p][1] for p in parts))
    n = 100_000
    found, count = lattice.Lattice(model, [" there"]).sample(np.zeros(n, dtype=np.int64), W.mix(np.arange(n, dtype=np.uint64)))
    ends = np.cumsum(count)
    seen = collections.Counter(tuple(found[e - c:e].tolist()) for e, c in zip(ends, count))
    total = sum(share.values())
    assert set(seen) <= set(share)
    for k, v in share.items():
        p = v / total
        assert abs(seen.get(k, 0) / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_lattice_on_edge_rows(edge, nothing):
    out = lattice.sample_pieces(edge, PIECES)
    back = lattice.decode_pieces(out.withColumn("text", F.lit("old")), PIECES)
    assert back.columns == ["doc_id", "n_pieces", "ids", "text"]
    rows = back.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in rows) == sorted(
        (i is None, i or 0, t or "") for i, t in EDGE_ROWS)
    assert all(len(r["ids"]) == 2 * r["n_pieces"] for r in rows)
    assert lattice.decode_pieces(lattice.sample_pieces(nothing, PIECES), PIECES).count() == 0


def test_draws_follow_the_row_key_alone(documents):
    def ids(df, **kw):
        return {r["doc_id"]: bytes(r["ids"]) for r in lattice.sample_pieces(df, PIECES, **kw).collect()}
    some = documents.limit(40)
    first = ids(some.repartition(7))
    assert first == ids(some.coalesce(1).orderBy(F.desc("doc_id")))
    other = ids(some, seed=1)
    assert sum(first[k] != other[k] for k in first) > 35


# ------------------------------------------------------------- operator 2
def test_word_ids_are_the_tokenizers():
    known = packing.word_ids(WORDS)
    texts = ["İstanbul Σίσυφος don't I'LL we've a's <|endoftext|> x", "éa Å Å K ﬁ", "日本語テスト 1２3 ½ x² \x85y \x1cq\x1f",
             "###'s''t ..  🙂🙂 ñÑ ǅ", "", "A.B,c... 'tis", "THE\n\tEnd.,", " a "]
    texts += [t for _, t in EDGE_ROWS if t]
    for t in texts:
        got = np.frombuffer(known.of_text(t.encode()), dtype=known.dtype).tolist()
        assert got == known.tokenizer.encode(t, add_special_tokens=False).ids


def test_word_ids_with_a_small_memory(monkeypatch, documents):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 7)
    known = packing.WordIds(WORDS)
    for r in documents.limit(5).collect():
        got = np.frombuffer(known.of_text(r["text"].encode()), dtype=known.dtype).tolist()
        assert got == known.tokenizer.encode(r["text"], add_special_tokens=False).ids


def test_texts_are_encoded_together_each_word_once(monkeypatch):
    """Texts of a chunk, also one that begins within a larger array, have the
    tokenizer's ids; a word that they repeat reaches the tokenizer once."""
    texts = ["Ab, ab <|endoftext|> x", None, "Σίσυφος Ab don't İx", "", " ", "ab AB, Σίσυφος é\xa0a 3½ don't", "<|x", "q\x1fr"]
    known = packing.WordIds(WORDS)
    want = [known.tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID] for t in texts * 50]
    array = pa.array(["cut off"] * 3 + texts * 50 + ["cut off"], pa.large_string()).slice(3, len(want))
    whole, merged = [], []
    monkeypatch.setattr(known, "whole", lambda t, own=known.whole: whole.append(t) or own(t))
    monkeypatch.setattr(known, "merge", lambda t, own=known.merge: merged.append(t) or own(t))
    flat, ends = known.of_texts(array)
    assert [x.tolist() for x in np.split(flat, ends[:-1])] == want and ends[-1] == len(flat)
    assert sorted(set(whole)) == sorted({texts[0], texts[6], "Σίσυφος", "İx", "q\x1fr", "é\xa0a"}) and len(whole) == 104
    assert len(merged) == len(set(merged))
    assert known.of_texts(array.slice(5, 1))[0].tolist() == want[5]


def test_a_small_chunk_changes_nothing(monkeypatch, documents):
    own = packing.pack_documents(documents, WORDS)
    rows = sorted(map(tuple, own.collect()))
    monkeypatch.setattr(packing, "CHUNK_BYTES", 5000)
    monkeypatch.setattr(packing, "CHUNK_TOKENS", 700)
    table = documents.select("doc_id", "text", F.lit(0).cast("long").alias("text_hash")).toArrow()
    run = pa.Table.from_batches(packing._tokenize(WORDS)(table.to_batches()))
    assert {i: len(x) // 2 for i, x in zip(run["doc_id"].to_pylist(), run["ids"].to_pylist()) if x} == {
        r[0]: r[4] for r in rows}
    held = [set(np.frombuffer(x, dtype="<u2").tolist()) for x in run["ids"].to_pylist() if x]
    df = {t: n for t, n in zip(run["token"].to_pylist(), run["df"].to_pylist()) if n}
    assert df == dict(collections.Counter(t for own in held for t in own))


def check_packing(pieces, rows, window=2048):
    tokenizer = Tokenizer.from_file(WORDS)
    sequences, docs = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
        docs[p["doc_id"], p["doc_tokens"]].append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at == window or at & (at - 1) == 0 and at < window
    want = collections.Counter()
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want[i, len(ids)] += len(ids)
        for p in docs[i, len(ids)]:
            raw = np.frombuffer(p["ids"], dtype="<u2").astype("<u4")
            assert zlib.crc32(raw.tobytes()) == p["ids_crc32"] and len(raw) == p["length"]
        if sum(j == i for j, _ in rows) == 1:
            at = 0
            for p in sorted(docs[i, len(ids)], key=lambda p: p["start"]):
                assert p["start"] == at
                assert zlib.crc32(ids[at:at + p["length"]].tobytes()) == p["ids_crc32"]
                at += p["length"]
            assert at == len(ids)
    assert {k: sum(p["length"] for p in v) for k, v in docs.items() if v} == dict(want)


def test_packing_of_edge_rows(edge, nothing):
    check_packing(packing.pack_documents(edge, WORDS).collect(), EDGE_ROWS)
    assert packing.pack_documents(nothing, WORDS).count() == 0


@pytest.mark.parametrize("shard_tokens", [3000, 1 << 20])
def test_packing_of_documents(documents, shard_tokens):
    out = packing.pack_documents(documents, WORDS, shard_tokens=shard_tokens).collect()
    check_packing(out, [(r["doc_id"], r["text"]) for r in documents.collect()])


def test_neighbours_by_bm25_fill_the_window():
    """The search's scores are BM25's, and a seed's window holds its kin."""
    rng = np.random.default_rng(0)
    topic = [rng.integers(100 * k, 100 * k + 60, 50) for k in (1, 2, 3, 4) for _ in range(5)]
    n = np.full(20, 50)
    flat = np.concatenate(topic).astype(np.uint16)
    df = np.bincount(np.concatenate([np.unique(d) for d in topic]), minlength=1000)
    idf = np.log1p((20 - df + 0.5) / (df + 0.5)).astype(np.float32)
    index = packing.Index(flat, n, idf, 50.0)
    near = index.search(7, np.arange(20) != 7, 3)
    query = index.token[index.bounds[7]:index.bounds[8]]
    weight = index.weight[index.bounds[7]:index.bounds[8]]
    shared = [t for w, t in sorted(zip(-weight, query)) if df[t] > 1]

    def bm25(d):
        tf = collections.Counter(topic[d].tolist())
        return sum(idf[t] * tf[t] * (packing.K1 + 1) / (tf[t] + packing.K1) for t in shared if tf[t])
    scores = {d: bm25(d) for d in range(20) if d != 7}
    assert min(scores[d] for d in near) >= sorted(scores.values())[-3] - 1e-4
    packed = packing.pack_shard(n, index, window=250)
    assert all({d // 5 for d, _, _ in s} == {s[0][0] // 5} for s in packed) and len(packed) == 4


def test_all_shared_tokens_count_and_all_neighbours_are_asked_for():
    """Forty short kin of a seed fit its window, also those after the 32nd;
    a document that shares many light tokens is nearer than one with 24 heavy ones."""
    kin = [np.array([500, 501, 10 * k + 600]) for k in range(41)]
    other = [np.array([5000 + k, 5500]) for k in range(41)]
    topic = [d for pair in zip(kin, other) for d in pair]
    n = np.array([len(d) for d in topic])
    idf = np.ones(6000, dtype=np.float32)
    index = packing.Index(np.concatenate(topic).astype(np.uint16), n, idf, 2.5)
    assert {d % 2 for d, _, _ in packing.pack_shard(n, index, window=3 * 41)[0]} == {0}

    seed, heavy, light = np.arange(200), np.arange(24), np.arange(24, 200)
    flat, n = np.concatenate([seed, heavy, light]).astype(np.uint16), np.array([200, 24, 176])
    idf = np.where(np.arange(200) < 24, 2, 1).astype(np.float32)
    index = packing.Index(flat, n, idf, 1e9)
    assert index.search(0, np.array([False, True, True]), 2) == [2, 1]


# ------------------------------------------------------------- operator 4
SECRETS = [
    'password = "hunter22" and PASSWD:abcdef', "token=abc api_key: 'x/y+z=12' apikey=toolong1", "éé secret: ſecret=abcdefg",
    "AKIA" + "A1" * 8 + " AKIASHORT AKIAAKIA" + "B" * 20, "deadbeef" * 3 + " " + "a" * 23 + " ABCDEF" + "0" * 24,
    "token=token\": abcdefgh", "", None, "toKen=abc123 toKen=abc123", "K" * 3 + " ſecret=abcdef",
]


def brute_spans(text):
    out = []
    pattern = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    pattern += r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for rank, (kind, p, group, least) in enumerate((("assign", pattern, 2, 6), ("access", "AKIA[A-Z0-9]+", 0, 20),
                                                    ("hex", "[0-9a-f]+", 0, 24))):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(p, text or "") if len(m[group]) >= least]
    return sorted(out)


def test_secret_spans(spark):
    rows = [(i, t) for i, t in enumerate(SECRETS)] + [(None, SECRETS[0]), (0, SECRETS[0])] + [(99, t) for _, t in EDGE_ROWS]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")
    out = secret_ledger.scan_secrets(df).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["blob"], [tuple(s) for s in r["spans"]]) for r in out)
    assert got == sorted((i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest(), brute_spans(t)) for i, t in rows)
    assert secret_ledger.scan_secrets(df.limit(0)).count() == 0


def test_the_ledger_scans_only_what_it_has_not_seen(spark):
    path = scratch_path(spark, "ledger")
    seen = spark.sparkContext.accumulator(0)

    def rule(version):
        def find(text):
            seen.add(1)
            return [m.span() for m in re.finditer("x+", text)]
        return secret_ledger.Rule("x", version, find)

    def scan(texts, version="1"):
        before = seen.value
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
        out = secret_ledger.scan_secrets(df, path, (rule(version),)).collect()
        return seen.value - before, {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in out}
    assert scan(["ax", "ax", "b", None]) == (3, {0: [(1, 2)], 1: [(1, 2)], 2: [], 3: []})
    assert scan(["b", "xx", "ax"]) == (1, {0: [], 1: [(0, 2)], 2: [(1, 2)]})
    assert scan(["b", "xx"])[0] == 0
    assert scan(["b", "xx"], version="2") == (2, {0: [], 1: [(0, 2)]})


def test_redaction(spark):
    df = spark.createDataFrame([(1, "a password=hunter22 b", "k"), (2, None, "k"), (3, "clean", "k"),
                                (4, "token=" + "a" * 30 + " c", "k")], "doc_id long, text string, blob string")
    got = {r["doc_id"]: (r["text"], r["blob"]) for r in secret_ledger.redact(df).collect()}
    assert got == {1: ("a [assign] b", "k"), 2: (None, "k"), 3: ("clean", "k"), 4: ("[assign] c", "k")}


def test_long_prose_has_no_secret():
    assert not any(f(prose(3, 5000)) for f in (secret_ledger.assign, secret_ledger.access))


def test_two_commits_scan_each_pair_once(spark, edge):
    """The second commit meets the first one's ledger: it scans only blobs that
    were not in it."""
    path = scratch_path(spark, "ledger")
    half = F.when(F.col("doc_id") % 2 == 0, 0).otherwise(1)
    out = secret_ledger.scan_secrets(edge, path, commit=half, commits=2).collect()
    assert len(out) == len(EDGE_ROWS)
    ledger = secret_ledger.read_ledger(spark, path)
    first = {t or "" for i, t in EDGE_ROWS if i is not None and i % 2 == 0}
    both = {t or "" for _, t in EDGE_ROWS}
    files = ledger.groupBy("blob", "rule").count()
    assert files.filter("count > 1").count() == 0                                    # no pair twice
    assert ledger.count() == len(secret_ledger.BASE_RULES) * len(both) and first < both
    whole = {tuple(map(str, r)) for r in secret_ledger.scan_secrets(edge).collect()}
    assert whole == {tuple(map(str, r)) for r in out}


def test_identical_rows_are_split_over_shards(spark):
    """A third of all rows may be one row: its copies go to many shards."""
    rows = [(1, "one two three")] * 3000
    pieces = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), WORDS,
                                    shard_tokens=1000).collect()
    size = collections.Counter()
    for p in pieces:
        size[p["sequence_id"] >> 32] += p["length"]
    assert len(size) >= 9 and max(size.values()) < 3 * 1000


def test_a_shard_of_empty_texts_is_packed_fast():
    import time
    n = np.ones(100_000, dtype=np.int64)
    index = packing.Index(np.ones(100_000, dtype="<u2"), n, np.full(10, 0.1, dtype=np.float32), 1.0)
    start = time.perf_counter()
    sequences = packing.pack_shard(n, index)
    assert time.perf_counter() - start < 5 and sum(len(s) for s in sequences) == 100_000
