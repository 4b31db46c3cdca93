"""Queries of problem 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.splitting import LIMIT, OVERLAP, split_oversized, text_size
from pagewright.session import table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks that the splitting operator cut."""
    pieces = split_oversized(table(spark, sf_dir, "chunks"), only_oversized=True)
    return pieces.where("piece_no = 0 and n_pieces > 1").select("chunk_id")


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_oversized(table(spark, sf_dir, "chunks"))


def p4_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per cut chunk what must hold of its pieces: sizes within the limit, own parts that join to the text, consecutive
    numbers, and the overlap in front of every piece but the first."""
    chunks = table(spark, sf_dir, "chunks").select("chunk_id", "text").dropDuplicates(["chunk_id"])
    p = split_oversized(table(spark, sf_dir, "chunks"), only_oversized=True)
    own = F.expr("substring(piece, cast(own_start - start + 1 as int), cast(end - own_start as int))")
    shared = text_size(F.expr("substring(piece, 1, cast(own_start - start as int))"))
    per = p.groupBy("chunk_id").agg(
        F.max("size").alias("size"),
        F.count(F.lit(1)).alias("n"),
        F.max("n_pieces").alias("n_pieces"),
        F.max("piece_no").alias("last"),
        F.min(F.when(F.col("piece_no") > 0, shared)).alias("least"),
        F.max(F.when(F.col("piece_no") > 0, shared)).alias("most"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", own.alias("t")))), lambda x: x["t"]), "").alias("joined"),
    )
    return per.join(chunks, "chunk_id").select(
        "chunk_id",
        (F.col("size") <= LIMIT).alias("within_limit"),
        ((F.col("n") == F.col("n_pieces")) & (F.col("last") == F.col("n") - 1)).alias("numbered"),
        (F.col("joined") == F.col("text")).alias("joins"),
        ((F.col("least") == OVERLAP) & (F.col("most") == OVERLAP)).alias("overlaps"),
    )


_SIZE = "CAST(floor(len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]')) * 1.3) AS INTEGER) + 1"

QUERIES = {"p4_found": p4_found, "p4_pieces": p4_pieces, "p4_check": p4_check}
SQL = {
    "p4_found": f"SELECT DISTINCT chunk_id FROM chunks WHERE {_SIZE} > 1024",
    "p4_check": f"SELECT DISTINCT chunk_id, true AS within_limit, true AS numbered, true AS joins, true AS overlaps FROM chunks WHERE {_SIZE} > 1024",
}
