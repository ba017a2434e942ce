"""Shared DuckDB SQL fragments that mirror the Spark analyzers and derived tables."""

from __future__ import annotations


def ws(expr: str) -> str:
    """Whitespace tokens (the documents contain only ASCII whitespace)."""
    return f"list_filter(string_split_regex({expr}, '\\s+'), lambda x: x <> '')"


# Benchmark query set: all whitespace tokens of each item.
BENCH_Q = f"""bq AS (
  SELECT item_id AS query_id, unnest(range(len(t))) AS qpos, unnest(t) AS term
  FROM (SELECT item_id, {ws('text')} AS t FROM benchmark))"""

# Term-frequency postings over documents.
DOC_TF = f"""tfp AS (
  SELECT term, doc_id, count(*) AS tf, any_value(doc_len) AS doc_len
  FROM (SELECT doc_id, len(t) AS doc_len, unnest(t) AS term
        FROM (SELECT doc_id, {ws('text')} AS t FROM documents WHERE text IS NOT NULL))
  GROUP BY term, doc_id)"""

DOC_STATS = f"""st AS (
  SELECT count(*) AS n_docs, avg(coalesce(len({ws('text')}), 0)::DOUBLE) AS avg_len FROM documents)"""

# Judged pairs derived from documents + labels.
JUDG = """judg AS (
  SELECT q.item_id AS query_id, q.text AS query, l.doc_id,
         CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 'E'
              WHEN l.quality = 1 AND l.toxic = 1 THEN 'S'
              WHEN l.quality = 0 AND l.toxic = 0 THEN 'C' ELSE 'I' END AS label,
         CASE WHEN q.item_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         d.text AS title, d.text AS description
  FROM labels l JOIN documents d USING (doc_id)
  JOIN benchmark q ON q.item_id = TRY_CAST(regexp_extract(d.source, '(\\d+)', 1) AS BIGINT))"""


def unit_sum(value: str) -> str:
    """Sum of contributions as whole billionths, which no order of addition changes."""
    return f"sum(CAST(round(({value}) * 1e9) AS BIGINT)) / 1e9"


def ordered_sum(order: str, value: str) -> str:
    """Sum in a fixed order, matching quarry.functions.scoring.ordered_sum."""
    return f"list_reduce(list_transform(list_sort(list({{'o': {order}, 'v': {value}}})), lambda x: x.v), lambda a, b: a + b)"


def idf(n: str, df: str) -> str:
    return f"ln(({n} - {df} + 0.5) / ({df} + 0.5))"


def bm25_w(tf: str, k1: str, b: str, length: str, avg: str) -> str:
    return f"(({tf}) * ({k1} + 1.0)) / (({tf}) + {k1} * (1.0 - {b} + {b} * {length} / {avg}))"


def bm25f_w(tf: str, boost: str, b: str, length: str, avg: str) -> str:
    return f"(({tf}) * {boost}) / (1.0 - {b} + {b} * {length} / {avg})"


def md5_mod(expr: str, m: int) -> str:
    """int(md5(x), 16) % m by folding four 32-bit pieces (m < 2^31)."""
    pieces = [f"('0x' || substr(md5({expr}), {1 + 8 * i}, 8))::BIGINT" for i in range(4)]
    r = f"({pieces[0]} % {m})"
    for p in pieces[1:]:
        r = f"(({r} * 4294967296 + {p}) % {m})"
    return r
