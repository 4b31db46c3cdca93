"""The document model over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.plans.sqltext import PAGE_LINES
from pagewright.session import spread, table


def once(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the first delivered. Only keys are counted; the rows of keys delivered once pass
    through without a shuffle as long as the repeated keys are few enough for an automatic broadcast
    (a check of their size at run time), and only repeated rows are compared."""
    again = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(key)
    cols = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*cols), F.struct(F.col(order).isNull(), F.col(order))).alias("r")
    repeated = df.join(again, key, "left_semi").groupBy(key).agg(first).select(key, *[F.col(f"r.{c}").alias(c) for c in cols])
    return df.join(again, key, "left_anti").select(key, *cols).unionByName(repeated)


def profiles(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return once(table(spark, d, "profiles").select("doc_id", "loaded_at", *cols), "doc_id", "loaded_at")


def sections(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return once(table(spark, d, "sections").select("section_id", "loaded_at", *cols), "section_id", "loaded_at")


def chunks(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return once(spread(table(spark, d, "chunks").select("chunk_id", "created_at", *cols)), "chunk_id", "created_at")


def glossary(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    return once(table(spark, d, "glossary").select("term_id", "loaded_at", *cols), "term_id", "loaded_at")


def doc_pages(spark: SparkSession, d: str, lines: int = PAGE_LINES) -> DataFrame:
    """(doc_id, page_no, text): the text layer, `lines` lines a page. A narrow explode."""
    t = spread(table(spark, d, "documents").where("text is not null").select("doc_id", "text")).select("doc_id", F.split("text", "\n").alias("a"))
    n = F.ceil(F.size("a") / F.lit(lines)).cast("int")
    t = t.withColumn("page_no", F.explode(F.sequence(F.lit(1), n)))
    return t.select("doc_id", "page_no", F.array_join(F.slice("a", (F.col("page_no") - 1) * lines + 1, F.lit(lines)), "\n").alias("text"))
