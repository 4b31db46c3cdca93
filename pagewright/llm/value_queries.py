"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.canonical_values import _is_blank, map_to_list
from pagewright.session import table


def p5_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_kind, rec_id, section_type) of each free-entered section type, rows delivered again included."""
    exact = table(spark, sf_dir, "section_types").select("section_type").distinct()
    both = table(spark, sf_dir, "sections").select(
        F.lit("section").alias("rec_kind"), F.col("section_id").alias("rec_id"), "section_type"
    ).unionByName(
        table(spark, sf_dir, "chunks").select(F.lit("chunk").alias("rec_kind"), F.col("chunk_id").alias("rec_id"), "section_type")
    )
    # the list's size is checked at run time: it is only broadcast if it is small
    free = both.where(F.col("section_type").isNotNull() & ~_is_blank(F.col("section_type")))
    return free.join(exact, "section_type", "left_anti").select("rec_kind", "rec_id", "section_type")


def _mapped(spark: SparkSession, sf_dir: str, keep: list[str]) -> DataFrame:
    types = table(spark, sf_dir, "section_types")
    best = F.coalesce(F.get("matches", F.lit(0))["entry"], F.lit(0)).alias("type_id")
    return map_to_list(p5_cases(spark, sf_dir), "section_type", types, "type_id", ["section_type", "label"], ["other_names"], keep).select(*keep, best)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["rec_kind", "rec_id"]
    return _mapped(spark, sf_dir, keys).dropDuplicates(keys)


def p5_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that mean no entry, by kind of record, with the number of their records."""
    keys = ["rec_kind", "rec_id", "section_type"]
    lost = _mapped(spark, sf_dir, keys).where("type_id = 0").dropDuplicates(["rec_kind", "rec_id"])
    return lost.groupBy("rec_kind", "section_type").agg(F.count(F.lit(1)).alias("records"))


_CASES = r"""
SELECT s.rec_kind, s.rec_id, s.section_type FROM (
  SELECT 'section' AS rec_kind, section_id AS rec_id, section_type FROM sections UNION ALL
  SELECT 'chunk', chunk_id, section_type FROM chunks) s
WHERE s.section_type NOT IN (SELECT section_type FROM section_types)
  AND regexp_replace(s.section_type, '[\s\p{Z}\x{85}\x{200b}\x{feff}\x0b\x1c-\x1f]+', '', 'g') <> ''
"""

QUERIES = {"p5_found": p5_found, "p5_unmatched": p5_unmatched, "p5_cases": p5_cases}
SQL: dict[str, str] = {"p5_cases": _CASES}
