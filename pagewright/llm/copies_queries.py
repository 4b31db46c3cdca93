"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm.format_copies import collapse, keyed_lines
from pagewright.session import table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(keyed_lines(table(spark, sf_dir, "chunk_lines"), "line_id", "raw"))[1]


def p2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(keyed_lines(table(spark, sf_dir, "chunk_lines"), "line_id", "raw"))[0]


def _text(x: str) -> str:
    return f"regexp_replace(replace(lower({x}), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"


def _str(f: str) -> str:
    return "coalesce('s' || " + _text(f"(raw ->> '$.{f}')") + ", 'n')"


def _list(f: str) -> str:
    parts = f"list_transform(CAST(json_extract_string(raw, '$.{f}[*]') AS VARCHAR[]), lambda x: 's' || " + _text("x") + ")"
    return f"coalesce(array_to_string({parts}, '|'), '-')"


_CANON = " || '#' || ".join(
    [_str(f) for f in ("text", "source_file", "section_title", "section_type", "section_summary")]
    + [_list(f) for f in ("keywords", "cross_references")]
    + [f"coalesce(raw ->> '$.{f}', 'n')" for f in ("chunk_index", "page_start", "page_end", "token_count")]
)
_KEYED = f"""WITH l AS MATERIALIZED (SELECT line_id, raw FROM chunk_lines WHERE json_valid(raw) AND raw LIKE '%{{%'),
k AS (SELECT line_id, {_CANON} AS canon FROM l),
w AS (SELECT line_id, min(line_id) OVER (PARTITION BY canon) AS keep_id FROM k)
"""

QUERIES = {"p2_found": p2_found, "p2_counts": p2_counts}
SQL = {
    "p2_found": _KEYED + "SELECT keep_id, line_id AS copy_id FROM w WHERE keep_id <> line_id",
    "p2_counts": _KEYED + "SELECT keep_id, count(*) AS n_copies FROM w GROUP BY keep_id",
}
