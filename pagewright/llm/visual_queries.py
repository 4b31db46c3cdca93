"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm.visual_form import normal_form
from pagewright.operators.skew import FLOOR, hot_keys, join_small_side
from pagewright.session import materialize, table


SALTS = 32


def _hash(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws("\x01", *parts).cast("binary")))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_kind, id, scope, text) of terms and chunks."""
    terms = table(spark, sf_dir, "glossary").select(
        F.lit("term").alias("rec_kind"), F.col("term_id").alias("id"), F.col("doc_id").cast("string").alias("scope"), F.col("term").alias("text")
    )
    chunks = table(spark, sf_dir, "chunks").select(
        F.lit("chunk").alias("rec_kind"), F.col("chunk_id").alias("id"), F.col("source_file").alias("scope"), "text"
    )
    return terms.unionByName(chunks).where("id is not null and scope is not null and text is not null")


def same_looking_pairs(records: DataFrame, floor: int = FLOOR) -> DataFrame:
    """(rec_kind, id_a, id_b): all pairs of records of one kind and scope whose texts differ but
    have the same normal form; id_a < id_b. Blank texts take no part; a record delivered again (same
    id and text) counts once, of an id with several texts each takes part.

    Only hashes are shuffled. Groups of one single spelling, however large, are dropped by a
    combining aggregate before any pair is made.
    """
    raw = F.col("text")
    src = records.withColumn("raw", F.unhex(F.md5(raw.cast("binary"))))
    # texts of plain ASCII signs are their own form and never leave the JVM
    plain = (F.octet_length("text") == F.length("text")) & ~F.contains("text", F.lit("\r"))
    formed = normal_form(src.where(~plain), "text", ["rec_kind", "id", "scope", "raw"]).unionByName(
        src.where(plain).select("rec_kind", "id", "scope", "raw", F.col("text").alias("form"))
    )
    formed = formed.where(F.length(F.trim(F.regexp_replace("form", r"\s+", " "))) > 0)
    keyed = materialize(formed.select("rec_kind", "id", _hash(F.col("rec_kind"), F.col("scope"), F.col("form")).alias("g"), "raw"), "forms")
    mixed = keyed.groupBy("g").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("g")
    hot = materialize(hot_keys(keyed, "g", floor), "hot-forms")
    members = materialize(join_small_side(keyed, mixed, "g", hot).select("rec_kind", "id", "g", "raw").distinct(), "variants")
    # a large group's left side is dealt out to salts, each of which meets the whole group
    salted = members.join(F.broadcast(hot.withColumn("hot", F.lit(SALTS))), "g", "left").withColumn("n", F.coalesce("hot", F.lit(1)))
    a = salted.withColumn("salt", F.pmod(F.xxhash64("id"), "n").cast("int"))
    b = salted.select("g", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"), F.col("id").alias("id_b"), F.col("raw").alias("raw_b"))
    pairs = a.join(b, ["g", "salt"]).where("id < id_b and raw <> raw_b")
    return pairs.select("rec_kind", F.col("id").alias("id_a"), "id_b").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_looking_pairs(_records(spark, sf_dir))


def p6_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normal_form(_records(spark, sf_dir), "text", ["rec_kind", "id"])


QUERIES = {"p6_found": p6_found, "p6_forms": p6_forms}
SQL: dict[str, str] = {}
