"""Top-k retrieval: exact in blocks, and an inverted-file index.

Exact search multiplies blocks of queries with blocks of vectors; each task holds one pair of
blocks and keeps the best k of its queries, so memory follows the block sizes only. The index is
fitted on a bounded sample, holds every row, and scans the cells nearest to a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.session import materialize

BLOCK = 20_000
#: Texts of one block of keyword search.
TEXT_BLOCK = 10_000
#: Most rows the index is fitted on.
FIT_SAMPLE = 50_000


def predicates(filters: dict | None) -> Column:
    """{"col": value} is equality, {"col >=": value} a comparison; all must hold."""
    cond = F.lit(True)
    ops = {"=": "eq", ">=": "ge", "<=": "le", ">": "gt", "<": "lt", "!=": "ne"}
    for k, v in (filters or {}).items():
        name, _, op = k.partition(" ")
        cond = cond & getattr(F.col(name), f"__{ops[op or '=']}__")(F.lit(v))
    return cond


def _matrix(x: pd.Series) -> np.ndarray:
    m = np.stack(x.to_numpy()).astype(np.float64) if len(x) else np.empty((0, 1))
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1, n)


def _best(q: pd.DataFrame, v: pd.DataFrame, k: int, step: int = 1024) -> pd.DataFrame:
    out = []
    if q.empty or v.empty:
        return pd.DataFrame({"query_id": q["id"].iloc[:0], "id": v["id"].iloc[:0], "score": np.empty(0)})
    vm, ids = _matrix(v["vec"]), v["id"].to_numpy()
    order = np.argsort(ids, kind="stable")  # ties go to the smaller id
    vm, ids = vm[order], ids[order]
    for at in range(0, len(q), step):
        part = q.iloc[at : at + step]
        s = _matrix(part["vec"]) @ vm.T
        best = np.argsort(-s, axis=1, kind="stable")[:, :k]
        for row, qid in enumerate(part["id"].to_numpy()):
            out.append(pd.DataFrame({"query_id": qid, "id": ids[best[row]], "score": s[row, best[row]]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "score": []})


def _top(cands: DataFrame, k: int) -> DataFrame:
    """The best k per query, ties by id. The limit on the row number is applied in every task before the shuffle, so
    that each sends k rows of a query at most."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "id", vec_col: str = "embedding", filters: dict | None = None, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the k rows of largest cosine for each query, ties by id; filters
    hold before the search. Rows with a null vector take no part; all-zero vectors score 0."""
    v = vectors.where(predicates(filters)).select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where("vec is not null")
    q = queries.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where("vec is not null")
    nv, nq = (max(1, math.ceil(x.count() / block)) for x in (v, q))
    v = v.withColumn("vb", F.pmod(F.xxhash64("id"), F.lit(nv))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)).cast("array<bigint>")))
    q = q.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(nq))).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(nv - 1)).cast("array<bigint>")))
    kind = v.schema["id"].dataType.simpleString()
    qk = q.schema["id"].dataType.simpleString()
    found = q.groupBy("vb", "qb").cogroup(v.groupBy("vb", "qb")).applyInPandas(lambda a, b: _best(a, b, k), f"query_id {qk}, id {kind}, score double")
    return _top(found, k)


def sampled(vectors: DataFrame, id_col: str = "id", vec_col: str = "embedding", sample: int = FIT_SAMPLE) -> np.ndarray:
    """At most `sample` unit vectors, chosen by a hash of their id."""
    rows = vectors.where(F.col(vec_col).isNotNull()).select(id_col, vec_col).orderBy(F.xxhash64(id_col), id_col).limit(sample).toPandas()
    if rows.empty:
        raise ValueError("no vectors to fit an index on")
    return _matrix(rows[vec_col])


def fit_index(
    vectors: DataFrame, cells: int | None = None, id_col: str = "id", vec_col: str = "embedding", sample: int = FIT_SAMPLE, rounds: int = 15, x: np.ndarray | None = None
) -> np.ndarray:
    """Cell centres (spherical k-means) from at most `sample` rows, chosen by a hash of their id; `x` are these rows if
    they were drawn before (`sampled`)."""
    x = sampled(vectors, id_col, vec_col, sample) if x is None else x
    cells = min(len(x), cells or max(1, int(math.sqrt(len(x)))))
    c = x[np.random.default_rng(7).choice(len(x), cells, replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        for j in range(cells):
            m = x[near == j]
            if len(m):
                s = m.sum(axis=0)
                c[j] = s / (np.linalg.norm(s) or 1)
    return c


def probes_for(vectors: DataFrame, centres: np.ndarray, k: int = 5, target: float = 0.95, id_col: str = "id", vec_col: str = "embedding", sample: int = FIT_SAMPLE, queries: int = 500, x: np.ndarray | None = None) -> int:
    """The fewest cells to scan for a recall of `target` against brute force, measured on the sample."""
    x = sampled(vectors, id_col, vec_col, sample) if x is None else x
    q = x[:queries]
    true = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :k]
    cell = (x @ centres.T).argmax(axis=1)
    place = np.argsort(np.argsort(-(q @ centres.T), axis=1), axis=1)  # rank of every cell for each query
    need = np.sort(np.take_along_axis(place, cell[true], axis=1).ravel())
    return int(need[min(len(need) - 1, math.ceil(target * len(need)) - 1)]) + 1


def assign_cells(vectors: DataFrame, centres: np.ndarray, probes: int = 1, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec, cell): every row in its nearest cell, or in its nearest `probes` cells (queries)."""
    src = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where("vec is not null")
    bc = src.sparkSession.sparkContext.broadcast(centres)  # sqrt(sample) rows at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                near = np.argsort(-(_matrix(b["vec"]) @ bc.value.T), axis=1)[:, :probes]
                yield b.loc[b.index.repeat(near.shape[1])].assign(cell=near.ravel().astype(np.int32))

    return src.mapInPandas(run, f"id {src.schema['id'].dataType.simpleString()}, vec array<float>, cell int")


def index_topk(index: DataFrame, queries: DataFrame, centres: np.ndarray, k: int = 5, probes: int = 8, id_col: str = "id", vec_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """As `vector_topk` over the `probes` nearest cells. Cells are spread by id over as many parts as hold about
    `block` rows of the largest cell, so that no group grows with the table."""
    largest = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    parts = max(1, math.ceil(largest / block))
    q = assign_cells(queries, centres, probes, id_col, vec_col).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")))
    v = index.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)))
    kind, qk = v.schema["id"].dataType.simpleString(), q.schema["id"].dataType.simpleString()
    found = q.groupBy("cell", "part").cogroup(v.groupBy("cell", "part")).applyInPandas(lambda a, b: _best(a, b, k), f"query_id {qk}, id {kind}, score double")
    return _top(found.distinct(), k)


def keyword_scores(docs: DataFrame, queries: DataFrame, id_col: str = "id", text_col: str = "text", least: int = 4) -> DataFrame:
    """(query_id, id, score): sum over the query's different words of round(1000 ln(1 + N / df)) where the
    text holds the word. Integer weights make the score exact."""
    n = docs.count()
    dw = docs.select(F.col(id_col).alias("id"), F.explode_outer(F.array_distinct(T.words(F.col(text_col), least))).alias("word")).where("word is not null")
    qw = queries.select(F.col(id_col).alias("query_id"), F.explode(F.array_distinct(T.words(F.col("query"), least))).alias("word"))
    used = dw.join(qw.select("word").distinct(), "word", "left_semi")
    df = used.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weight = df.select("word", F.round(F.lit(1000.0) * F.log(F.lit(1.0) + F.lit(float(n)) / F.col("df"))).cast("bigint").alias("w"))
    return used.join(qw.join(weight, "word"), "word").groupBy("query_id", "id").agg(F.sum("w").alias("score"))


def hybrid_topk(vector_hits: DataFrame, keyword_hits: DataFrame, k: int = 5, c: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists (query_id, rank, id): score = sum of 1 / (c + rank)."""
    both = vector_hits.select("query_id", "rank", "id").unionByName(keyword_hits.select("query_id", "rank", "id"))
    s = both.groupBy("query_id", "id").agg(F.sum(F.lit(1.0) / (F.col("rank") + c)).alias("score"))
    return _top(s, k)


def _word_best(q: pd.DataFrame, v: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k texts of the block for each query (before is null), and for each text it asks for, how
    many texts of the block stand before that one."""
    out = []
    v = v.sort_values("id")  # ties go to the smaller id
    ids = v["id"].to_numpy()
    if len(q) and len(v):
        vocabulary = {w: i for i, w in enumerate({w for a in q["words"] for w in a})}
        sizes = v["words"].map(len).to_numpy()
        code = np.fromiter((vocabulary.get(w, -1) for a in v["words"] for w in a), np.int64, sizes.sum())
        at = np.repeat(np.arange(len(v)), sizes)[code >= 0]
        code = code[code >= 0]
        at = at[np.argsort(code, kind="stable")]
        ends = np.cumsum(np.bincount(code, minlength=len(vocabulary)))
        for r in q.itertuples():
            s = np.zeros(len(v), np.int64)
            for word, weight in zip(r.words, r.weights, strict=True):
                i = vocabulary[word]
                s[at[ends[i - 1] if i else 0 : ends[i]]] += weight
            found = np.flatnonzero(s)
            if len(found) > k:
                found = found[s[found] >= np.partition(s[found], -k)[-k]]
            found = found[np.argsort(-s[found], kind="stable")[:k]]
            out.append(pd.DataFrame({"query_id": r.id, "id": ids[found], "score": s[found], "before": None}))
            if r.want_ids is not None and len(r.want_ids):
                place = np.searchsorted(ids, r.want_ids)
                n = [np.count_nonzero(s > t) + np.count_nonzero(s[:p] == t) for t, p in zip(r.want_scores, place, strict=True)]
                out.append(pd.DataFrame({"query_id": r.id, "id": r.want_ids, "score": r.want_scores, "before": n}))
    return pd.concat([x.astype({"before": "Int64"}) for x in out]) if out else pd.DataFrame({c: pd.Series([], dtype="Int64") for c in ("query_id", "id", "score", "before")})


def keyword_ranks(docs: DataFrame, queries: DataFrame, depth: int, pairs: DataFrame, least: int = 4, block: int = TEXT_BLOCK) -> DataFrame:
    """(query_id, id, rank) by the scores of `keyword_scores`, ties by id: the first `depth` texts of each query
    and those of `pairs` (query_id, id) that share a word with it, at their rank among all texts. Blocks of
    texts meet blocks of queries, so that no (query, text) pair is shuffled beyond these."""
    n = docs.count()
    v = docs.select("id", F.array_distinct(T.words(F.col("text"), least)).alias("words"))
    df = v.select(F.explode_outer("words").alias("word")).where("word is not null").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weight = df.select("word", F.round(F.lit(1000.0) * F.log(F.lit(1.0) + F.lit(float(n)) / F.col("df"))).cast("bigint").alias("w"))
    qw = queries.select(F.col("id").alias("query_id"), F.explode(F.array_distinct(T.words(F.col("query"), least))).alias("word"))
    qw = materialize(qw.join(weight, "word"), "query-words")
    asked = pairs.join(v, "id").select("query_id", "id", F.explode("words").alias("word")).join(qw, ["query_id", "word"])
    asked = asked.groupBy("query_id", "id").agg(F.sum("w").alias("score")).groupBy("query_id").agg(F.collect_list(F.struct("id", "score")).alias("want"))
    q = qw.groupBy("query_id").agg(F.collect_list(F.struct("word", "w")).alias("a")).join(asked, "query_id", "left")
    q = q.select(F.col("query_id").alias("id"), F.col("a.word").alias("words"), F.col("a.w").alias("weights"), F.col("want.id").alias("want_ids"), F.col("want.score").alias("want_scores"))
    q, v = _meet(materialize(q, "word-queries"), v, max(1, math.ceil(queries.count() / block)), max(1, math.ceil(n / block)))
    kinds = f"query_id {q.schema['id'].dataType.simpleString()}, id {v.schema['id'].dataType.simpleString()}, score bigint, before bigint"
    found = materialize(q.groupBy("vb", "qb").cogroup(v.groupBy("vb", "qb")).applyInPandas(lambda a, b: _word_best(a, b, depth), kinds), "word-ranks")
    asked = found.where("before is not null").groupBy("query_id", "id").agg((F.sum("before") + 1).cast("int").alias("rank"))
    return _top(found.where("before is null"), depth).select("query_id", "id", "rank").unionByName(asked).distinct()


def _meet(q: DataFrame, v: DataFrame, nq: int, nv: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the keys vb and qb of every pair of their blocks."""
    v = v.withColumn("vb", F.pmod(F.xxhash64("id"), F.lit(nv))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)).cast("array<bigint>")))
    return q.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(nq))).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(nv - 1)).cast("array<bigint>"))), v


def _vectors_before(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
    """For each vector a query asks for, how many vectors of the block stand before it."""
    out = []
    if len(q) and len(v):
        v = v.sort_values("id")
        vm, ids = _matrix(v["vec"]), v["id"].to_numpy()
        for qm, r in zip(_matrix(q["vec"]), q.itertuples(), strict=True):
            # einsum adds up each row alike, wherever it stands: equal vectors tie
            s = np.einsum("ij,j->i", vm, qm)
            t = np.einsum("ij,j->i", _matrix(pd.Series([*np.reshape(r.want_vecs, (len(r.want_ids), -1))])), qm)
            place = np.searchsorted(ids, r.want_ids)
            n = [np.count_nonzero(s > x) + np.count_nonzero(s[:p] == x) for x, p in zip(t, place, strict=True)]
            out.append(pd.DataFrame({"query_id": r.id, "id": r.want_ids, "before": n}))
    return pd.concat(out) if out else pd.DataFrame({c: pd.Series([], dtype="int64") for c in ("query_id", "id", "before")})


def vector_ranks(vectors: DataFrame, queries: DataFrame, pairs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(query_id, id, rank): the rank of each of `pairs` (query_id, id) among all vectors, as `vector_topk` orders them."""
    v = vectors.select("id", F.col("embedding").alias("vec")).where("vec is not null")
    q = queries.select("id", F.col("embedding").alias("vec")).where("vec is not null")
    nv, nq = (max(1, math.ceil(x.count() / block)) for x in (v, q))
    want = pairs.join(v, "id").groupBy("query_id").agg(F.collect_list(F.struct("id", "vec")).alias("want"))
    q = q.join(want.withColumnRenamed("query_id", "id"), "id").select("id", "vec", F.col("want.id").alias("want_ids"), F.flatten("want.vec").alias("want_vecs"))
    q, v = _meet(materialize(q, "vector-queries"), v, nq, nv)
    kinds = f"query_id {q.schema['id'].dataType.simpleString()}, id {v.schema['id'].dataType.simpleString()}, before bigint"
    found = q.groupBy("vb", "qb").cogroup(v.groupBy("vb", "qb")).applyInPandas(_vectors_before, kinds)
    return found.groupBy("query_id", "id").agg((F.sum("before") + 1).cast("int").alias("rank"))


def hybrid_search(vectors: DataFrame, vector_queries: DataFrame, docs: DataFrame, queries: DataFrame, k: int = 5, c: int = 60) -> DataFrame:
    """`hybrid_topk` of the two whole rankings: vectors (id, embedding), docs (id, text), queries (id, query).

    Only the first c + 2k of each list and their ranks in the other list are formed. A row in neither has
    2 / (2c + 2k + 1) at most; a list of k rows or more has k scores of 1 / (c + k) at least, which is more,
    and shorter lists are whole."""
    depth = c + 2 * k
    near = materialize(vector_topk(vectors, vector_queries, depth).select("query_id", "id"), "near")
    words = materialize(keyword_ranks(docs, queries, depth, near), "words")
    return hybrid_topk(vector_ranks(vectors, vector_queries, near.union(words.select("query_id", "id")).distinct()), words, k, c)


def ranked(scores: DataFrame, k: int) -> DataFrame:
    return _top(scores, k)
