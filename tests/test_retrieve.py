"""Hybrid search against the fusion of both whole rankings."""

from pyspark.sql import functions as F

from pagewright.operators import retrieve as R
from pagewright.session import table

ALL = 10**6


def parts(spark, sf):
    docs = table(spark, sf, "documents").select((F.col("doc_id") - 1001).alias("id"), "text").where("text is not null")
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return docs, v, docs.where("id % 20 = 0").select("id", F.col("text").alias("query"))


def hits(df):
    return sorted((r.query_id, r["rank"], r.id) for r in df.collect())


def test_hybrid_search_fuses_whole_rankings(spark, sf):
    docs, v, q = parts(spark, sf)
    vq = v.where("id % 20 = 0")
    whole = R.hybrid_topk(R.vector_topk(v, vq, ALL), R.ranked(R.keyword_scores(docs, q), ALL), 5)
    assert hits(R.hybrid_search(v, vq, docs, q, 5)) == hits(whole)


def test_true_ranks_are_looked_up(spark, sf):
    docs, v, q = parts(spark, sf)
    pairs = spark.createDataFrame([(0, i) for i in range(100)], "query_id long, id long")
    whole = {(r.query_id, r.id): r["rank"] for r in R.ranked(R.keyword_scores(docs, q), ALL).collect()}
    got = {(r.query_id, r.id): r["rank"] for r in R.keyword_ranks(docs, q, 3, pairs, block=30).collect()}
    assert got == {x: n for x, n in whole.items() if n <= 3 or x[0] == 0}
    whole = {r.id: r["rank"] for r in R.vector_topk(v, v.where("id = 0"), ALL).collect()}
    got = {r.id: r["rank"] for r in R.vector_ranks(v, v.where("id = 0"), pairs, block=200).collect()}
    assert got == {i: whole[i] for i in range(100)}


def test_rank_21_of_both_lists_beats_first_of_one(spark):
    """Vector order 0, 1, 2, ...; document 21 is also 21st of the words, all before it stand in one list's front only."""
    n = 200
    v = spark.createDataFrame([(i, [1.0, 0.01 * i]) for i in range(n)], "id long, embedding array<float>")
    docs = spark.createDataFrame([(i, "word other" if i >= 100 and i < 120 else "word" if i in (20, *range(150, 200)) else "nothing") for i in range(n)], "id long, text string")
    q = spark.createDataFrame([(0, "word other")], "id long, query string")
    got = hits(R.hybrid_search(v, v.where("id = 0"), docs, q, 5))
    assert got[0] == (0, 1, 20)


def test_registered_query_uses_all_words(spark, sf):
    from pagewright.plans.export_queries import hybrid_topk

    docs, v, q = parts(spark, sf)
    whole = R.hybrid_topk(R.vector_topk(v, v.where("id % 20 = 0"), ALL), R.ranked(R.keyword_scores(docs, q), ALL), 5)
    assert hits(hybrid_topk(spark, sf)) == hits(whole)
