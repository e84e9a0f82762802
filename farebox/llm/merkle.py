"""Merkle dataset manifest with checkpoint-and-recompute proofs (operator 12).

Rows are leaves of one tree per group; every ``ARITY`` consecutive nodes
become one node of the next level, their SHA-256, while a level has more than
one. The groups' roots, in order, are the leaves of the tree above.

Only every ``STRIDE``-th level is persisted, as one row per aligned subtree of
``SPAN`` nodes. Proofs are extracted from the top down: a task takes one
aligned subtree, regenerates its missing interior nodes from the stored
descendants, emits each descendant's siblings on top of those of the subtree's
root, and discards the interior nodes.

Leaves are numbered by a range partitioning over (group, order): each
partition is sorted, and the counts of the partitions before it give a group's
offset. So a group that holds a third of all rows is many tasks throughout.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import prepare, stored

# Fixed value: nodes that become one node of the next level.
ARITY = 16
STRIDE = 2                # levels from one persisted level to the next
SPAN = ARITY ** STRIDE    # nodes of an aligned subtree

STEPS = "array<struct<before:string,after:string>>"
WHOLE = ""                # the one tree above all groups


def field(column: Column) -> Column:
    """UTF-8 byte count, colon, value; a null is a dash."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """Lowercase hex SHA-256 of the fields, concatenated."""
    return F.sha2(F.concat(*(field(c) for c in columns)), 256)


def fold(digest: Column, steps: Column) -> Column:
    """The root that ``digest`` leads to with the siblings of ``steps``."""
    return F.aggregate(steps, digest, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def siblings(steps: Column) -> Column:
    """All siblings from the leaf upwards, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ..) with ``idx``, the place of each row in its tree by
    ``order`` (rows that tie: in any order), and ``n``, the rows of the tree."""
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    dealt = stored(tied.repartitionByRange("tree", *order, "tie").sortWithinPartitions("tree", *order, "tie")
                   .drop("tie").withColumn("place", F.monotonically_increasing_id()), "merkle-sorted")
    part = F.shiftright("place", 33)
    runs = dealt.groupBy("tree", part.alias("part")).agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")   # a tree has one run a partition at the most
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")
    runs = runs.select("tree", "part", shift.alias("shift"), F.sum("rows").over(tree).alias("n"))
    return (dealt.withColumn("part", part).join(runs, ["tree", "part"])
            .withColumn("idx", F.col("place") + F.col("shift")).drop("part", "place", "shift"))


def _above(nodes: list[str], n: int) -> list[list[str]]:
    """The levels of an aligned subtree: its ``nodes``, then the interior ones,
    regenerated. ``n`` is the number of nodes of the whole tree on the level of
    ``nodes``: a level of one node is the last."""
    levels = [nodes]
    for _ in range(STRIDE):
        if n > 1:
            below = levels[-1]
            levels.append([hashlib.sha256("".join(below[a:a + ARITY]).encode()).hexdigest()
                           for a in range(0, len(below), ARITY)])
            n = -(-n // ARITY)
    return levels


def _tops(batches):
    """Of each subtree: the node above all its nodes."""
    for batch in batches:
        top = [_above([x["h"] for x in nodes], n)[-1][0] for nodes, n in
               zip(batch.column("nodes").to_pylist(), batch.column("n").to_pylist())]
        up = [-(-n // SPAN) for n in batch.column("n").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("sub"), pa.array(up, pa.int64()),
                                          pa.array(top, pa.string())], ["tree", "idx", "n", "h"])


def _steps_of(levels: list[list[str]], i: int) -> list[dict]:
    out = []
    for nodes in levels[:-1]:
        a = i - i % ARITY
        out.append({"before": "".join(nodes[a:i]), "after": "".join(nodes[i + 1:a + ARITY])})
        i //= ARITY
    return out


def _paths(columns: list[str]):
    """Each node of each subtree with its siblings up to the tree's root and on."""
    def run(batches):
        for batch in batches:
            schema = pa.schema([(f.name, f.type) for f in batch.schema.field("nodes").type.value_type])
            steps_type = batch.schema.field("steps").type
            for k in range(batch.num_rows):   # one subtree is at most SPAN rows
                row = batch.slice(k, 1)
                nodes = pa.Table.from_pylist(row.column("nodes").to_pylist()[0], schema=schema).combine_chunks()
                size = nodes.num_rows
                levels = _above(nodes.column("h").to_pylist(), row.column("n")[0].as_py())
                rest = row.column("steps").to_pylist()[0]
                steps = [_steps_of(levels, i) + rest for i in range(size)]
                same = {c: pa.repeat(row.column(c)[0], size) for c in ("tree", "subroot")}
                made = {"steps": pa.array(steps, steps_type), **same,
                        **{c: nodes.column(c).combine_chunks() for c in schema.names}}
                yield pa.RecordBatch.from_arrays([made[c] for c in columns], columns)
    return run


@dataclass
class Manifest:
    """Persisted levels, from the leaves upwards: rows (tree, sub, n, nodes),
    one per aligned subtree; ``roots`` (tree, h); ``payload``: (name, type)
    of what else the leaves carry."""

    levels: list[DataFrame]
    roots: DataFrame
    payload: list[tuple[str, str]]


def build(rows: DataFrame) -> Manifest:
    """From (tree, idx, n, h, payload..): every ``STRIDE``-th level of each
    tree, one job a persisted level."""
    prepare(rows.sparkSession)
    payload = [(c, t) for c, t in rows.dtypes if c not in ("tree", "idx", "n", "h")]
    levels, roots, nodes = [], None, rows
    while True:
        node = F.struct("idx", "h", *(c for c, _ in (payload if not levels else [])))
        level = stored(nodes.groupBy("tree", F.expr(f"idx div {SPAN}").alias("sub"), "n")
                       .agg(F.array_sort(F.collect_list(node)).alias("nodes")), "merkle-level")
        levels.append(level)
        done = level.filter(F.col("n") <= SPAN).mapInArrow(_tops, "tree string, idx long, n long, h string")
        done = done.select("tree", "h")
        roots = done if roots is None else roots.unionByName(done)
        open_ = level.filter(F.col("n") > SPAN)
        if open_.isEmpty():
            return Manifest(levels, roots, payload)
        nodes = open_.mapInArrow(_tops, "tree string, idx long, n long, h string")


def proofs(manifest: Manifest, tops: DataFrame) -> DataFrame:
    """(tree, idx, h, payload.., subroot, steps) of each leaf. ``tops`` (tree,
    subroot, steps) has the siblings of each tree's root further up."""
    above = None
    for k in reversed(range(len(manifest.levels))):
        level = manifest.levels[k]
        parents = (level.filter(F.col("n") <= SPAN).select("tree", "sub").join(tops, "tree"))
        if above is not None:
            parents = parents.unionByName(above)
        extra = manifest.payload if k == 0 else []
        columns = ["tree", "idx", "h", *(c for c, _ in extra), "subroot", "steps"]
        types = {"tree": "string", "idx": "long", "h": "string", "subroot": "string", "steps": STEPS, **dict(extra)}
        out = level.join(parents, ["tree", "sub"]).mapInArrow(
            _paths(columns), ", ".join(f"`{c}` {types[c]}" for c in columns))
        if k == 0:
            return out
        above = stored(out.select("tree", F.col("idx").alias("sub"), "subroot", "steps"), "merkle-proofs")


def dataset_manifest(rows: DataFrame, group: str, order: str) -> tuple[DataFrame, str | None]:
    """Of ``rows`` with ``leaf`` and any further columns: (these columns,
    subroot, steps), where ``steps`` holds the siblings before and after the
    node of each level from the leaf to the root of all; and that root.

    Groups are those of the string column ``group`` (null is a group, the
    first; then by UTF-8 bytes); leaves ascend by ``order``, nulls first, then
    by ``leaf``. Rows that repeat are leaves of their own. An empty table has
    no rows and no root. A column's own name never clashes: all but ``leaf``
    travel under names of their own."""
    prepare(rows.sparkSession)
    spark = rows.sparkSession
    names = rows.columns
    own = {c: f"c{i}" for i, c in enumerate(names)}
    # null sorts below every string: "0" against "1" and the string
    tree = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`")), F.lit("0"))
    leaves = stored(rows.select(tree.alias("tree"), F.col("leaf").alias("h"),
                                *(F.col(f"`{c}`").alias(own[c]) for c in names if c != "leaf")), "merkle-leaves")
    groups = build(numbered(leaves, [own[order], "h"]))
    whole = build(numbered(groups.roots.select(F.lit(WHOLE).alias("tree"), "h", F.col("tree").alias("name")), ["name"]))
    root = whole.roots.first()
    if root is None:
        return rows.limit(0).select("*", F.lit(None).cast("string").alias("subroot"),
                                    F.lit(None).cast(STEPS).alias("steps")), None
    here = stored(spark.range(1).select(F.lit(WHOLE).alias("tree"), F.lit(root["h"]).alias("subroot"),
                                        F.array().cast(STEPS).alias("steps")), "merkle-root")
    tops = stored(proofs(whole, here).select(F.col("name").alias("tree"), F.col("h").alias("subroot"), "steps"),
                  "merkle-proofs")
    out = proofs(groups, tops)
    return out.select(*(F.col("h" if c == "leaf" else own[c]).alias(c) for c in names), "subroot", "steps"), root["h"]
