"""Queries of problem 3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.repeated_lines import frequent_sequences, strip_repeated
from pagewright.session import table


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chunks").select("chunk_id", "source_file", "text")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    occ, _ = frequent_sequences(_chunks(spark, sf_dir))
    return occ.select(F.col("id").alias("chunk_id"), "line_no")


def p3_own_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir)
    occ, _ = frequent_sequences(chunks)
    return strip_repeated(chunks, occ)


def p3_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many sequences of each length are frequent, and in how many documents the widest is."""
    _, seq = frequent_sequences(_chunks(spark, sf_dir))
    return seq.groupBy("length").agg(F.count(F.lit(1)).alias("sequences"), F.max("docs").alias("most_docs"))


_LINES = """
WITH d AS (SELECT DISTINCT chunk_id, source_file, text FROM chunks WHERE text IS NOT NULL AND source_file IS NOT NULL),
s AS (SELECT chunk_id, source_file, string_split(text, chr(10)) AS a FROM d),
l AS (SELECT chunk_id, source_file, unnest(a) AS line, unnest(range(1, len(a) + 1)) AS line_no FROM s),
k AS (SELECT chunk_id, source_file, line_no, regexp_replace(replace(lower(line), 'ß', 'ss'), '[^\\p{L}]+', '', 'g') AS key FROM l),
f AS (SELECT source_file, key, count(DISTINCT chunk_id) AS n FROM k WHERE key <> '' GROUP BY 1, 2 HAVING count(DISTINCT chunk_id) >= 8),
o AS (SELECT k.chunk_id, k.source_file, k.line_no, k.key, row_number() OVER (PARTITION BY k.chunk_id ORDER BY k.line_no) AS r
      FROM k JOIN f USING (source_file, key))
"""
# every part of every document's frequent lines; the documents of one part are counted per source
_SEQ = _LINES + """,
q AS (SELECT chunk_id, source_file, list(key ORDER BY r) AS keys FROM o GROUP BY ALL),
b AS (SELECT chunk_id, source_file, keys, unnest(range(1, len(keys) + 1)) AS lo FROM q),
e AS (SELECT chunk_id, source_file, keys, lo, unnest(range(lo, len(keys) + 1)) AS hi FROM b),
p AS (SELECT chunk_id, source_file, hi - lo + 1 AS length, md5(array_to_string(keys[lo:hi], '|')) AS pat FROM e),
n AS (SELECT length, source_file, pat, count(DISTINCT chunk_id) AS docs FROM p GROUP BY ALL HAVING count(DISTINCT chunk_id) >= 8)
SELECT CAST(length AS INTEGER) AS length, count(*) AS sequences, max(docs) AS most_docs FROM n GROUP BY length
"""
_OWN = _LINES + """,
g AS (SELECT chunk_id, list(line_no) AS gone FROM o GROUP BY chunk_id)
SELECT c.chunk_id, CASE WHEN g.gone IS NULL THEN c.text ELSE
    array_to_string(list_filter(string_split(c.text, chr(10)), lambda x, i: NOT list_contains(g.gone, i)), chr(10)) END AS own_text,
  coalesce(len(g.gone), 0) AS n_removed
FROM chunks c LEFT JOIN g USING (chunk_id)
"""

QUERIES = {"p3_found": p3_found, "p3_own_text": p3_own_text, "p3_sequences": p3_sequences}
SQL = {"p3_found": _LINES + "SELECT chunk_id, CAST(line_no AS INTEGER) AS line_no FROM o", "p3_sequences": _SEQ, "p3_own_text": _OWN}
