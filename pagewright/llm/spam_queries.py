"""Queries of problem 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm.page_spam import spam_pages
from pagewright.session import table


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam_pages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "page_labels"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_scores(spark, sf_dir).where("is_spam").select("doc_id")


QUERIES = {"p9_found": p9_found, "p9_scores": p9_scores}
SQL: dict[str, str] = {}
