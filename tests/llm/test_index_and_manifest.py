"""Operators 11, 12 and 13 against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.llm import digest_index, lexical, merkle
from farebox.llm.digest_index import DigestIndex
from farebox.session import scratch_path

from .conftest import EDGE_ROWS, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")   # fixed pattern
LOWER = {c: c + 32 for c in range(65, 91)}


# ------------------------------------------------------------ operator 11
def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_rank(docs, items, k):
    lists = [(i, terms(t)) for i, t in docs]
    lists = [(i, t) for i, t in lists if t]
    n_docs, n_terms = len(lists), sum(len(t) for _, t in lists)
    df = Counter(t for _, own in lists for t in set(own))
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, own in wanted.items():
        hits = []
        for doc, t in lists:
            m = 100 - 90 + (90 * len(t) * n_docs) // n_terms
            count, score = Counter(t), 0
            for x in own:
                if count[x]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                    score += w * ((1_000_000_000 * count[x]) // (1000 * count[x] + 8 * m))
            if score > 0:
                hits.append((-score, doc is None, doc or 0, doc, score))
        out += [(item, r, doc, s) for r, (*_, doc, s) in enumerate(sorted(hits, key=lambda h: h[:3])[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "one two"), (2, prose(1, 30)), (3, None), (4, ""), (5, "ONE one, don't 日本語 é"), (6, "nowhereseen"),
         (1, "SAME"), (None, "end tail"), (7, prose(99, 40) + " " + prose(5, 20)), (8, "\x7f[]{} ~^")]


def item_table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, score string")


def ranked(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("group_bytes,block,columns", [(1 << 20, 64, 1024), (64, 2, 3)])
def test_lexical_edge_rows(spark, edge, monkeypatch, group_bytes, block, columns):
    """Ties, repeated and null ids, items of one id, and several groups, blocks
    and tiles of terms."""
    monkeypatch.setattr(lexical, "ITEM_ROWS", block)
    monkeypatch.setattr(lexical, "TERM_COLUMNS", columns)
    got = ranked(lexical.rank(edge, item_table(spark, ITEMS), k=4, group_bytes=group_bytes))
    assert got == brute_rank(EDGE_ROWS, ITEMS, 4) and len({r[0] for r in got}) >= 5


def test_lexical_ties_beyond_a_tile(spark, monkeypatch):
    """More equal documents than k, over several tiles and tasks: the smallest ids win."""
    monkeypatch.setattr(lexical, "DOC_ROWS", 7)
    docs = [(i, "alpha beta") for i in range(300, 0, -1)] + [(1000 + i, "gamma") for i in range(50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    items = [(1, "alpha"), (2, "gamma alpha")]
    got = ranked(lexical.rank(df, item_table(spark, items), k=10))
    assert got == brute_rank(docs, items, 10)
    assert [r[2] for r in sorted(got) if r[0] == 1] == list(range(1, 11))


def test_lexical_empty_tables(spark, edge):
    items = item_table(spark, ITEMS)
    for docs, wanted in ((edge.limit(0), items), (edge, items.limit(0)), (edge.filter("text is null"), items)):
        out = lexical.rank(docs, wanted)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []


def test_partial_products_are_exact():
    """The widest tile keeps every partial sum below 2^53, for any corpus."""
    heaviest = lexical.weights_of(2 ** 62, np.array([1]))[0]
    width = min(lexical.TERM_COLUMNS, (lexical.EXACT - 1) // (heaviest * (lexical.PEAK // lexical.WEIGHT)))
    assert width * heaviest * (lexical.PEAK // lexical.WEIGHT) < 2 ** 53 and width >= 1


# ------------------------------------------------------------ operator 12
def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][a:a + 16]) for a in range(0, len(levels[-1]), 16)])
    return levels


def brute_path(levels, i):
    out = []
    for nodes in levels[:-1]:
        a = i - i % 16
        out.append((nodes[a:i], nodes[i + 1:a + 16]))
        i //= 16
    return out


def brute_manifest(rows):
    """[(doc_id, leaf, subroot, root, proof_sha256, folded_root)] of (doc_id, source, text)."""
    groups = defaultdict(list)
    for doc, source, text in rows:
        other = text.translate(LOWER) if text is not None and doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 else text
        groups[source].append((doc, sha(field(doc), field(source), field(text)), sha(field(doc), field(source), field(other))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    own = {s: brute_levels([r[1] for r in groups[s]]) for s in names}
    whole = brute_levels([own[s][-1][0] for s in names]) if names else [[]]
    out = []
    for k, s in enumerate(names):
        for i, (doc, leaf, other) in enumerate(groups[s]):
            path, folded = brute_path(own[s], i) + brute_path(whole, k), other
            for before, after in path:
                folded = sha(*before, folded, *after)
            out.append((doc, leaf, own[s][-1][0], whole[-1][0], sha(*(x for b, a in path for x in b + a)), folded))
    return sorted(out, key=str)


def manifest(spark, rows):
    schema = "doc_id long, source string, text string, steps string, tree string, h string"
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema).repartition(4)
    cells = [F.col("doc_id"), F.col("source")]
    other = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf(*cells, F.translate(
        "text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    leaves = df.drop("steps").select("*", merkle.leaf(*cells, F.col("text")).alias("leaf"), other.alias("tampered"))
    out, root = merkle.dataset_manifest(leaves, "source", "doc_id")
    assert set(leaves.columns) < set(out.columns)
    got = out.select("doc_id", "leaf", "subroot", F.lit(root), F.sha2(merkle.siblings(F.col("steps")), 256),
                     merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps"))).collect()
    return sorted(map(tuple, got), key=str)


SIZES = {"a": 1, "b": 2, "c": 16, "d": 17, "é": 256, "z": 257, None: 33, "": 1}


def test_manifest_of_all_tree_sizes(spark):
    """Lone leaves, full and partial runs, subtrees of exactly one span and one more."""
    rows = [(1000 * g + i, s, f"Text {i} {s}" if i % 7 else None)
            for g, (s, n) in enumerate(SIZES.items()) for i in range(n)]
    got = manifest(spark, rows)
    assert got == brute_manifest(rows)
    assert {r[5] == r[3] for r in got} == {True, False}


def test_manifest_of_three_persisted_levels_and_many_groups(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ARITY", 16)
    rows = [(i, "hot" if i % 3 else f"s{i % 300}", f"T{i}") for i in range(5000)]
    assert manifest(spark, rows) == brute_manifest(rows)


def test_manifest_edge_rows(spark, edge):
    rows = [(i, None if n % 4 == 0 else f"s{n % 2}", t) for n, (i, t) in enumerate(EDGE_ROWS)]
    assert manifest(spark, rows) == brute_manifest(rows)
    assert manifest(spark, rows[:1]) == brute_manifest(rows[:1])
    assert manifest(spark, rows * 3) == brute_manifest(rows * 3)   # rows that repeat
    out, root = merkle.dataset_manifest(edge.limit(0).select("doc_id", F.lit("s").alias("source"), F.col("text").alias("leaf")),
                                        "source", "doc_id")
    assert out.collect() == [] and root is None


# ------------------------------------------------------------ operator 13
def brute_dedup(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    keep = {t: max((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    return sorted(((d, keep[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for d, t in rows), key=str)


def check_dedup(df, rows):
    got = df.select("doc_id", "keep_id", "group_size", F.lower(F.hex("digest")).alias("d"), "kept").collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == brute_dedup(rows)
    kept = Counter(r["d"] for r in got if r["kept"])
    assert set(kept.values()) <= {1} and len(kept) == len({r["d"] for r in got})   # one row of each text
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


@pytest.mark.parametrize("batches", [1, 3])
def test_dedup_edge_rows(spark, edge, batches):
    batch = F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches))
    check_dedup(digest_index.deduplicate(edge, batch=batch, batches=batches), EDGE_ROWS)
    assert digest_index.deduplicate(edge.limit(0), batches=1).collect() == []


def test_dedup_hot_text(spark, monkeypatch):
    """One text in half of all rows takes the broadcast way, the rest the buckets."""
    monkeypatch.setattr(digest_index, "HOT", 4)
    rows = [(i, "hot" if i % 2 else f"t{i % 40}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check_dedup(digest_index.deduplicate(df, batch=F.pmod("doc_id", F.lit(2)).cast("int"), batches=2), rows)


def narrow(spark, rows, start=0):
    out = [(d, hashlib.sha256(t.encode()).digest(), start + k) for k, (d, t) in enumerate(rows)]
    return spark.createDataFrame(out, "doc_id long, digest binary, row long")


def test_index_over_loads(spark, monkeypatch):
    """A load is taken in once; one that dies leaves nothing that is read; the
    index can be opened again."""
    path = scratch_path(spark, "index")
    index = DigestIndex(spark, path, 3)
    index.add(narrow(spark, [(1, "a"), (2, "b"), (3, "a")]), "first")
    index.add(narrow(spark, [(9, "zzz")]), "first")
    with monkeypatch.context() as m:
        m.setattr(index, "loads", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            index.add(narrow(spark, [(5, "a")]), "lost")
    second = narrow(spark, [(7, "b"), (8, "c"), (0, "a")], 100)
    # the second load dies after its rows are appended, before the ledger
    lost = second.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.max("row").alias("keep_row"),
                                        F.count("*").alias("n")).withColumn("load", F.lit("second"))
    lost.write.mode("append").insertInto(index.digests)
    state = {r["digest"]: (r["keep_id"], r["n"]) for r in DigestIndex(spark, path, 3).state().collect()}
    a, b, c = (hashlib.sha256(t.encode()).digest() for t in "abc")
    assert state == {a: (3, 2), b: (2, 1)}
    index.add(second, "third")
    state = {r["digest"]: (r["keep_id"], r["n"]) for r in index.state().collect()}
    assert state == {a: (3, 3), b: (7, 2), c: (8, 1)}
    stray = index.resolve(narrow(spark, [(1, "never")])).first()
    assert (stray["keep_id"], stray["group_size"], stray["kept"]) == (None, 0, False)


def test_index_is_never_shuffled(spark):
    """The anti-join merges the index by its buckets: only the new rows are exchanged."""
    index = DigestIndex(spark, scratch_path(spark, "index"), 8)
    index.add(narrow(spark, [(i, f"t{i}") for i in range(100)]), "first")
    known = index._read(index.digests, index.loads()).select("digest")
    new = narrow(spark, [(i, f"t{i}") for i in range(50, 150)]).join(known.hint("merge"), "digest", "left_anti")
    assert new.count() == 50
    plan = new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    below = plan[plan.index("SortMergeJoin"):]
    right = below[below.rindex("Sort [digest"):]
    assert "Exchange" not in right and "Bucketed: true" in right
