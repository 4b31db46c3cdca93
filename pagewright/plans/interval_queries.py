"""Queries of the interval problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.operators.intervals import coverage
from pagewright.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = table(spark, sf_dir, "sections").select("doc_id", "page_start", "page_end")
    domains = (
        table(spark, sf_dir, "profiles")
        .where("page_count > 0")
        .select("doc_id", F.lit(1).alias("lo"), F.col("page_count").alias("hi"))
    )
    spans = coverage(sections, domains)
    return spans.select(
        "doc_id",
        "span_kind",
        F.col("span_start").cast("int").alias("page_start"),
        F.col("span_end").cast("int").alias("page_end"),
    )


P1_SQL = """
WITH d AS (SELECT doc_id, max(page_count) AS n FROM profiles WHERE page_count > 0 GROUP BY doc_id),
p AS (SELECT doc_id, n, unnest(range(1, n + 1)) AS page FROM d),
c AS (SELECT DISTINCT p.doc_id, p.page FROM p JOIN sections s ON s.doc_id = p.doc_id
      AND s.page_start <= s.page_end AND p.page BETWEEN s.page_start AND s.page_end),
k AS (SELECT p.doc_id, p.page, CASE WHEN c.page IS NULL THEN 'gap' ELSE 'period' END AS span_kind
      FROM p LEFT JOIN c ON c.doc_id = p.doc_id AND c.page = p.page),
g AS (SELECT *, page - row_number() OVER (PARTITION BY doc_id, span_kind ORDER BY page) AS run FROM k)
SELECT doc_id, span_kind, CAST(min(page) AS INTEGER) AS page_start, CAST(max(page) AS INTEGER) AS page_end
FROM g GROUP BY doc_id, span_kind, run
"""

QUERIES = {"p1_found": p1_found}
SQL = {"p1_found": P1_SQL}
