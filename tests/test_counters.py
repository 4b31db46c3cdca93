"""Exact token counts, embedding with retries, usage summaries."""

import json

import pytest
from pyspark.sql import functions as F

from pagewright.functions import counters as K
from pagewright.operators import chunks as C
from pagewright.operators import model_call as M


@pytest.fixture
def vocabulary(tmp_path):
    spec = {"version": "1.0", "model": {"type": "WordLevel", "vocab": {"[UNK]": 0, "hello": 1, "world": 2}, "unk_token": "[UNK]"}, "pre_tokenizer": {"type": "Whitespace"}, "normalizer": None, "added_tokens": [], "truncation": None, "padding": None, "post_processor": None, "decoder": None}
    p = tmp_path / "tokenizer.json"
    p.write_text(json.dumps(spec))
    return str(p)


def test_exact_counter_and_its_fallback(spark, vocabulary):
    c = K.choose_counter(vocabulary)
    assert c.exact and K.load_counter(vocabulary)("hello world") == 2
    d = spark.createDataFrame([(1, "hello world"), (2, None), (3, "")], "id int, t string")
    assert [r.n for r in d.select("id", c.count(F.col("t")).alias("n")).orderBy("id").collect()] == [2, None, 0]
    for path in (None, "/nowhere.json"):
        assert not K.choose_counter(path).exact
    assert K.heuristic_count("hello, world") == d.limit(1).select(K.Counter().count(F.lit("hello, world"))).first()[0]


def test_packing_by_an_exact_counter(spark, vocabulary):
    rows = [(1, 1, i, t) for i, t in enumerate(["hello world", "a b c", "hello", "x " * 9, "end"])]
    d = spark.createDataFrame(rows, "doc int, sec int, ord int, text string")
    for name in ("keywords", "cross_references"):
        d = d.withColumn(name, F.array().cast("array<string>"))
    d = d.withColumn("page_start", F.lit(1)).withColumn("page_end", F.lit(1))
    got = C.assemble_chunks(d, "doc", "sec", "ord", 100, 6, start_index=4, counter=K.choose_counter(vocabulary)).orderBy("chunk_index").collect()
    assert [(r.chunk_index, r.token_count) for r in got] == [(4, 6), (5, 9), (6, 1)]
    assert got[0].text == "hello world\n\na b c\n\nhello"


def test_embedding_waits_and_checks():
    class Client:
        def __init__(self, answers):
            self.answers = answers

        def embed(self, texts):
            a = self.answers.pop(0)
            if isinstance(a, Exception):
                raise a
            return a

    waits = []
    ok = [[1.0, 0.0]]
    assert M.embed_texts(Client([M.RateLimited(7.0), M.RateLimited(), M.RateLimited(), ok]), ["a"], 2, wait=waits.append) == ok
    assert waits == [7.0, 2.0, 4.0]
    with pytest.raises(M.RateLimited):
        M.embed_texts(Client([M.RateLimited()] * 5), ["a"], 2, wait=waits.append)
    for bad in ([[1.0]], [], [[1.0, 0.0]] * 2):
        with pytest.raises(ValueError):
            M.embed_texts(Client([bad]), ["a"], 2, wait=waits.append)


def test_only_rows_without_a_vector_are_embedded(spark):
    d = spark.createDataFrame([(1, "a b", None), (2, "c", [0.5, 0.5]), (3, None, None)], "id int, embedding_text string, embedding array<float>")
    got = {r.id: r.embedding for r in M.embed_rows(d, lambda: M.HashEmbedder(2), 2).collect()}
    assert got[2] == [0.5, 0.5] and got[3] is None and len(got[1]) == 2


def test_usage_summary(spark):
    t = spark.createDataFrame([("m", 1200, 5, 0, 0, 2)], "model string, " + ", ".join(f"{c} long" for c in M.COUNTERS) + ", calls long")
    text = M.usage_summary(t, 1.5)
    assert "m: 2 calls, 1,200 input tokens" in text and text.endswith("cost: 1.50")
    assert M.usage_summary(t).endswith("cost: unknown")
