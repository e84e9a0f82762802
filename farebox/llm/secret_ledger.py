"""Secret scans with an incremental blob ledger (operator 4).

A blob is a text named by its SHA-256. The ledger is a Parquet table of
(blob, rule, version, starts, ends): what each rule version found in each blob, also
where it found nothing. A scan reads only the pairs of blob and rule version
that the ledger lacks, appends them, and joins all findings back to every
path that holds the blob, so copies and unchanged files cost nothing.

Copies are brought together by blob with a partial aggregation, so a blob that
a third of all rows hold is shipped once per task.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.session import path_exists, scratch_path

from .runtime import prepare

# Fixed patterns and least lengths of the three base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 6
# A run below the least length holds no match at all, so the length is part
# of these two patterns.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")


def assign(text: str) -> list[tuple[int, int]]:
    low = text.lower()  # a cheap necessary condition first
    if not ("passw" in low or "secret" in low or "token" in low or "api" in low):
        return []
    return [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]


def access(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in ACCESS.finditer(text)] if "AKIA" in text else []


def hexadecimal(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in HEX.finditer(text)]


@dataclass(frozen=True)
class Rule:
    """``find`` gives (start, end) in code points, end exclusive. A changed rule
    takes a new version; its blobs are then unseen again."""

    name: str
    version: str
    find: Callable[[str], list[tuple[int, int]]]

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


BASE_RULES = (Rule("assign", "1", assign), Rule("access", "1", access), Rule("hex", "1", hexadecimal))

LEDGER = "blob string, rule string, version string, starts array<long>, ends array<long>"


def _scan(rules: tuple[Rule, ...]):
    def run(batches):
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            blobs, todo = batch.column("blob").to_pylist(), batch.column("todo").to_pylist()
            for blob, text, keys in zip(blobs, batch.column("text"), todo):
                text = text.as_py()
                for rule in rules:
                    if rule.key in keys:
                        spans = rule.find(text)
                        for column, x in zip(out, (blob, rule.name, rule.version,
                                                   [a for a, _ in spans], [b for _, b in spans])):
                            column.append(x)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.string()) for x in out[:3]),
                 *(pa.array(x, pa.list_(pa.int64())) for x in out[3:])],
                ["blob", "rule", "version", "starts", "ends"])
    return run


def with_blob(rows: DataFrame, text_col: str) -> DataFrame:
    return rows.withColumn("blob", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.schema(LEDGER).parquet(path) if path_exists(spark, path) else None


def update_ledger(texts: DataFrame, path: str, rules: tuple[Rule, ...] = BASE_RULES) -> None:
    """Scan the blobs of ``texts`` (blob, text) for the rules whose version the
    ledger at ``path`` does not hold yet, and append what they find. The
    append is one commit: a scan that fails leaves the ledger as it was."""
    spark = texts.sparkSession
    prepare(spark)
    wanted = F.array(*(F.lit(r.key) for r in rules))
    blobs = texts.groupBy("blob").agg(F.first(F.coalesce("text", F.lit(""))).alias("text"))
    known = read_ledger(spark, path)
    if known is None:
        todo = blobs.withColumn("todo", wanted)
    else:
        seen = known.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("seen"))
        todo = (blobs.join(seen, "blob", "left")
                .withColumn("todo", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
                .drop("seen").filter(F.size("todo") > 0))
    todo.mapInArrow(_scan(rules), LEDGER).write.mode("append").option("compression", "zstd").parquet(path)


def findings(spark: SparkSession, path: str, rules: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """(blob, spans): of each blob of the ledger, what the given rule versions
    found, spans(start, rank, kind, end) by start and then in the rules' order."""
    order = {r.name: i for i, r in enumerate(rules)}
    rank = F.create_map(*(x for k, i in order.items() for x in (F.lit(k), F.lit(i))))
    in_force = F.concat_ws("@", "rule", "version").isin([r.key for r in rules])
    rows = (spark.read.schema(LEDGER).parquet(path).filter(in_force & (F.size("starts") > 0))
            .dropDuplicates(["blob", "rule", "version"]))
    spans = F.transform(F.arrays_zip("starts", "ends"), lambda x: F.struct(
        x["starts"].alias("start"), F.element_at(rank, F.col("rule")).alias("rank"),
        F.col("rule").alias("kind"), x["ends"].alias("end")))
    return (rows.select("blob", spans.alias("spans")).groupBy("blob")
            .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans")))


def scan_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = BASE_RULES,
                 text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 commit: Column | None = None, commits: int = 1) -> DataFrame:
    """The ``keep`` columns of each row, its blob and ``spans``: an array of
    (start, rank, kind, end), empty if there are none. ``ledger`` is the
    folder of an earlier scan, or a new one; by default a fresh folder below
    ``spark.checkpoint.dir``. The rows come in ``commits`` commits, by the value
    0, 1, .. of ``commit``; each scans only what the ledger lacks by then.

    A null text is the empty blob. Rows that repeat are paths of one blob. Ids
    play no part and may be null. The method itself adds no kind to the base
    ones; further rules may. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "ledger")
    texts = docs.select(F.col(text_col).alias("text"), (F.lit(0) if commit is None else commit).alias("commit"))
    for n in range(commits):
        update_ledger(with_blob(texts.filter(F.col("commit") == n).drop("commit"), "text"), ledger, rules)
    paths = with_blob(docs.select(*keep, F.col(text_col).alias("text")), "text").drop("text")
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    found = findings(spark, ledger, rules)
    return (paths.join(found, "blob", "left")
            .select(*keep, "blob", F.coalesce("spans", none).alias("spans")))


def joined(spans) -> F.Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _redact(text_at: int, names: list[str]):
    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                if spans:
                    out, at = [], 0
                    for s in spans:
                        if s["end"] > at:
                            if s["start"] >= at:
                                out += [texts[i][at:s["start"]], f"[{s['kind']}]"]
                            at = s["end"]
                    texts[i] = "".join(out) + texts[i][at:]
            columns = [batch.column(i) for i in range(len(names))]
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def redact(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = BASE_RULES,
           text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets (spans
    that overlap become the first one's). Rows without a finding are as they
    were; a null text stays null."""
    spark = docs.sparkSession
    ledger = ledger or scratch_path(spark, "ledger")
    update_ledger(with_blob(docs.select(F.col(text_col).alias("text")), "text"), ledger, rules)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    rows = with_blob(docs.toDF(*names), f"c{at}").join(findings(spark, ledger, rules), "blob", "left")
    rows = rows.select(*names, "spans")
    return rows.mapInArrow(_redact(at, names), docs.toDF(*names).schema).toDF(*docs.columns)
