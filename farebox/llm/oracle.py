"""DuckDB twins of the operators that SQL can state.

They state the definition, not the method: no twin knows of minimisers,
shards or ledgers. The others are tested against brute force, an exact round
trip or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"


def _windows(width: int) -> str:
    """Words of each document; its windows, numbered by place among all equal ones."""
    return rf"""
    words AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
    windows AS (
        SELECT doc_id, s, array_to_string(list_slice(w, s, s + {width - 1}), ' ') AS content
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {width - 2})) AS s FROM words)),
    placed AS (
        SELECT doc_id, s, row_number() OVER (PARTITION BY content ORDER BY doc_id, s) AS nth,
               count(*) OVER (PARTITION BY content) AS places
        FROM windows),
    removed AS (
        SELECT DISTINCT doc_id, unnest(range(s, s + {width})) AS k FROM placed WHERE nth > 1)"""


SUPER_KMERS = rf"""
WITH {_windows(20)},
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM words)
    ANTI JOIN removed USING (doc_id, k)
    GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

SUFFIXES = rf"""
WITH {_windows(50)},
covered AS (
    SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS k FROM placed WHERE places > 1),
numbered AS (
    SELECT c.doc_id, c.k, c.k - row_number() OVER (PARTITION BY c.doc_id ORDER BY c.k) AS stretch,
           r.k IS NOT NULL AS gone
    FROM covered c LEFT JOIN removed r ON r.doc_id = c.doc_id AND r.k = c.k)
SELECT doc_id, min(k) - 1 AS start, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed
FROM numbered GROUP BY doc_id, stretch
"""

TOP_K = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Fixed patterns of the base kinds. Letters in either case are spelt out: a match
# without regard to case would fold letters beyond ASCII as well.
_KEY = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in key)
                for key in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
_KINDS = (
    ("assign", 0, rf"""({_KEY})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    ("hex", 2, "[0-9a-f]+", 0, 24),
)


def _spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Matches by their place: the lengths of what is between and before them."""
    return rf"""
    SELECT doc_id, '{kind}' AS kind, {rank} AS rank, start, start + len(match) AS "end" FROM (
        SELECT doc_id, match, value,
               sum(len(gap)) OVER before + coalesce(sum(len(match)) OVER earlier, 0) AS start
        FROM (SELECT doc_id, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS match, unnest(v) AS value,
                     unnest(list_slice(g, 1, len(m))) AS gap
              FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m,
                           regexp_extract_all(t, '{pattern}', {group}) AS v,
                           regexp_split_to_array(t, '{pattern}') AS g
                    FROM texts))
        WINDOW before AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING),
               earlier AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    WHERE len(value) >= {least}"""


SECRETS = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(_spans(*k) for k in _KINDS)}),
joined AS (
    SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
           count(*) FILTER (WHERE kind = 'access') AS n_access,
           count(*) FILTER (WHERE kind = 'hex') AS n_hex,
           string_agg(kind || ':' || start::BIGINT || ':' || "end"::BIGINT, ',' ORDER BY start, rank) AS s
    FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(s, '')) AS base_sha256, coalesce(s, '') AS spans
FROM texts LEFT JOIN joined USING (doc_id)
"""

# The term pattern and the numbers of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEXICAL = rf"""
WITH lists AS (
    SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}') AS t
    FROM documents WHERE text IS NOT NULL),
total AS (SELECT count(*) AS n_docs, sum(len(t)) AS n_terms FROM lists WHERE len(t) > 0),
counts AS (SELECT doc_id, any_value(len(t)) AS n, u AS term, count(*) AS tf
           FROM (SELECT doc_id, t, unnest(t) AS u FROM lists) GROUP BY doc_id, u),
item_terms AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{TERM}')) AS term
    FROM benchmark WHERE text IS NOT NULL),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, total WHERE term IN (SELECT term FROM item_terms) GROUP BY term),
impacts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n::HUGEINT * n_docs) // n_terms)))::BIGINT AS x
    FROM counts JOIN weights USING (term), total),
scored AS (
    SELECT item_id, doc_id, sum(x)::BIGINT AS score FROM item_terms JOIN impacts USING (term) GROUP BY item_id, doc_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join([*(_field(c) for c in ("doc_id", "source", "lang", "n_chars")), text]) + ")"


def _tree(name: str, leaves: str, levels: int) -> str:
    """Nodes {name}0, {name}1, .. by level (tree, i, n, h), ``n`` of them in the
    tree, level by level while there are more than one; roots {name}_root."""
    out = [f"{name}0 AS ({leaves})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (
    SELECT tree, i // 16 AS i, (any_value(n) + 15) // 16 AS n, sha256(string_agg(h, '' ORDER BY i)) AS h
    FROM {name}{k} WHERE n > 1 GROUP BY tree, i // 16)""")
    every = " UNION ALL ".join(f"SELECT {k} AS level, * FROM {name}{k}" for k in range(levels + 1))
    out.append(f"{name}_all AS MATERIALIZED ({every})")
    out.append(f"{name}_root AS (SELECT tree, h FROM {name}_all WHERE n = 1)")
    return ",\n".join(out)


def _fold(name: str, start: str, levels: int) -> str:
    """{name}_path: of each row (id, tree, i, h) of ``start`` its siblings, level
    by level, and {name}_fold: what its h folds to."""
    paths = " UNION ALL ".join(
        f"SELECT id, {k} AS level, s.tree, s.i // {16 ** k} AS own FROM {start} s" for k in range(levels))
    out = [f"""{name}_path AS (
    SELECT p.id, string_agg(a.h, '' ORDER BY p.level, a.i) AS siblings
    FROM ({paths}) p JOIN {name}_all a
      ON a.level = p.level AND a.tree = p.tree AND a.n > 1 AND a.i // 16 = p.own // 16 AND a.i <> p.own
    GROUP BY p.id)""", f"{name}_f0 AS (SELECT id, tree, i, h FROM {start})"]
    for k in range(levels):
        out.append(f"""{name}_f{k + 1} AS (
    SELECT f.id, f.tree, any_value(f.i) // 16 AS i,
           CASE WHEN count(a.h) = 0 THEN any_value(f.h)
                ELSE sha256(string_agg(CASE WHEN a.i = f.i THEN f.h ELSE a.h END, '' ORDER BY a.i)) END AS h
    FROM {name}_f{k} f LEFT JOIN {name}_all a
      ON a.level = {k} AND a.tree = f.tree AND a.n > 1 AND a.i // 16 = f.i // 16
    GROUP BY f.id, f.tree)""")
    return ",\n".join(out)


LEVELS = 6   # 16^6 documents of a source, and as many sources

# Bit by bit: a byte of the id is mixed in before the first of its eight steps.
_CRC = """xor(4294967295, list_reduce(
    [4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))))"""

MERKLE = f"""
WITH rows AS (
    SELECT doc_id, coalesce('1' || source, '0') AS tree, {_leaf(_field('text'))} AS h,
           CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(_field(f"translate(text, '{_UPPER}', '{_LOWER}')"))} END AS other
    FROM documents),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
    FROM rows),
{_tree('s', 'SELECT tree, i, n, h FROM leaves', LEVELS)},
tops AS (SELECT tree AS id, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h FROM s_root),
{_tree('t', 'SELECT tree, i, n, h FROM tops', LEVELS)},
own AS (SELECT doc_id AS id, tree, i, coalesce(other, h) AS h FROM leaves),
{_fold('s', 'own', LEVELS)},
changed AS (SELECT f.id, '' AS tree, p.i, f.h FROM s_f{LEVELS} f JOIN tops p ON p.id = f.tree),
{_fold('t', 'changed', LEVELS)}
SELECT l.doc_id, l.h AS leaf, p.h AS subroot, r.h AS root,
       sha256(coalesce(sp.siblings, '') || coalesce(tp.siblings, '')) AS proof_sha256,
       f.h AS folded_root, f.h = r.h AS verified
FROM leaves l JOIN tops p ON p.id = l.tree CROSS JOIN t_root r JOIN t_f{LEVELS} f ON f.id = l.doc_id
LEFT JOIN s_path sp ON sp.id = l.doc_id LEFT JOIN t_path tp ON tp.id = l.doc_id
"""

SQL = {
    "op4_blob_ledger_secrets": SECRETS,
    "op8_sparse_suffix_arrays": SUFFIXES,
    "op9_super_kmer_dedup": SUPER_KMERS,
    "op10_tiled_top_k": TOP_K,
    "op11_blocked_lexical_search": LEXICAL,
    "op12_merkle_manifest": MERKLE,
    "op13_digest_index_dedup": EXACT_DEDUP,
}
