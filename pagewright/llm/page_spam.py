"""Keyword-stuffed pages and link lists.

Two kinds of evidence are joined per page:

- replication: what stands outside sentences is cut into phrase shingles (two words, the length of
  the usual keyword, and five), exploded, and the distinct hosts of each phrase are counted over the whole
  corpus, every host of a copied page included; the share of a page that consists of phrases which other
  hosts hold too tells pages stitched from common keywords, link and menu texts;
- list density: the share of words outside sentences, repeated words, links and list signs.

Phrases inside sentences are no evidence: in running text the commonest phrases stand on all hosts.
A logistic model over this evidence is fitted on a bounded sample of hand labels and applied to
every page. All counts cover all documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.operators.skew import hot_keys, join_small_side
from pagewright.session import materialize

SHINGLES = (2, 5)
MIN_HOSTS = 3
LABEL_SAMPLE = 20_000
FEATURES = ("replicated", "other_lists", "repetition", "sameness", "links", "marks")

_WORD = r"[\p{L}\p{M}\p{N}_]+"
_PARTS = r"(?<=[.!?])\s+|\n"
#: words written in one, as in tags
_JOINED = r"(?<=[\p{Ll}\p{N}])(?=\p{Lu})"


def _is_sentence(part: Column, words: Column) -> Column:
    """A part of 8 words or more that ends in a full stop (no ellipsis) or question mark, holds no link and does not
    consist of repeated words: at least 7 in 10 are different, 11 in longer parts."""
    n = F.size(words)
    form = (n >= 8) & F.rlike(part, F.lit(r"(?:\?|(?<!\.)\.)[\s\p{Z}]*$")) & ~F.contains(part, F.lit("://"))
    return form & (F.size(F.array_distinct(words)) * 10 >= F.least(n, F.lit(16)) * 7)


def _phrase_counts(runs: str, lengths: tuple[int, ...]) -> Column:
    """array<struct<h,c>>: the different phrases of `runs` (lists of words) and how often each occurs."""
    each = [
        f"flatten(transform({runs}, w -> case when size(w) >= {k} then transform(sequence(0, size(w) - {k}), "
        f"i -> xxhash64({', '.join(f'w[i + {j}]' for j in range(k))})) else cast(array() as array<bigint>) end))"
        for k in lengths
    ]
    first = "filter(sequence(0, size(s) - 1), i -> i = 0 or s[i] <> s[i - 1])"
    counted = f"transform(array({first}), f -> transform(f, (i, n) -> struct(s[i] as h, coalesce(get(f, n + 1), size(s)) - i as c)))[0]"
    empty = "cast(array() as array<struct<h:bigint,c:int>>)"
    return F.expr(f"transform(array(sort_array(concat({', '.join(each)}))), s -> case when size(s) > 0 then {counted} else {empty} end)[0]")


def _evidence(docs: DataFrame, id_col: str, text_col: str, host_col: str, lengths: tuple[int, ...]) -> DataFrame:
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(host_col)).alias("host"), F.col(host_col).isNotNull().alias("hosted"))
    d = d.where("id is not null and text is not null")
    parts = F.transform(F.split("text", _PARTS), lambda p: F.struct(p.alias("p"), F.regexp_extract_all(F.lower(p), F.lit(_WORD), F.lit(0)).alias("w")))
    d = d.select("id", "host", "hosted", parts.alias("parts"))
    loose = F.filter("parts", lambda x: (F.size(x["w"]) > 0) & ~_is_sentence(x["p"], x["w"]))
    n = F.aggregate("parts", F.lit(0), lambda a, x: a + F.size(x["w"]))
    different = F.size(F.array_distinct(F.flatten(F.transform("parts", lambda x: x["w"]))))
    d = d.select("id", "host", "hosted", n.alias("n"), different.alias("different"), loose.alias("loose"))
    runs = F.transform("loose", lambda x: F.regexp_extract_all(F.lower(F.regexp_replace(x["p"], _JOINED, " ")), F.lit(_WORD), F.lit(0)))
    text = F.array_join(F.transform("loose", lambda x: x["p"]), "\n")
    in_sentences = F.col("n") - F.aggregate("loose", F.lit(0), lambda a, x: a + F.size(x["w"]))
    d = d.select("id", "host", "hosted", in_sentences.alias("n"), "different", text.alias("text"), runs.alias("runs"))
    d = d.select("id", "host", "hosted", "n", "different", "text", "runs", F.aggregate("runs", F.lit(0), lambda a, x: a + F.size(x)).alias("m"))
    # no filter on computed columns here: it would be pushed down and compute them again
    return d.select(
        "id",
        "host",
        "hosted",
        (F.col("n") + F.col("m")).alias("n_words"),
        F.col("m").alias("n_listed"),
        F.col("different").alias("n_different"),
        (F.col("m") - F.size(F.array_distinct(F.flatten("runs")))).alias("n_repeated"),
        F.regexp_count("text", F.lit(r"://|<a |\]\(|#[\p{L}]")).alias("n_links"),
        F.regexp_count("text", F.lit(r"[|;/*+>»·•!,]|\.\.\.")).alias("n_marks"),
        _phrase_counts("runs", lengths).alias("phrases"),
    )


def page_evidence(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    lengths: tuple[int, ...] = SHINGLES,
    min_hosts: int = MIN_HOSTS,
) -> DataFrame:
    """(id, n_words, and the FEATURES) of every page with words; rows delivered again count once.

    `replicated` is the number of phrases outside sentences that stand on at least `min_hosts`
    other hosts there, per word of the page and phrase length: 0 for pages of sentences and for lists of
    words that no other host puts together, near 1 for pages made of common phrases. A null host is
    no host. Null, empty and wordless texts give no row. The other features count signs and repeated words
    outside sentences per word of the page.
    """
    pages = materialize(_evidence(docs, id_col, text_col, host_col, lengths), "pages").where("n_words > 0")
    rows = pages.select("id", "host", "hosted", F.explode("phrases").alias("e")).select("id", "host", "hosted", "e.h", "e.c")
    hosts = rows.where("hosted").select("h", "host").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n_hosts"))
    hosts = materialize(hosts.where(F.col("n_hosts") >= min_hosts), "replicated")
    hits = join_small_side(rows, hosts, "h", materialize(hot_keys(rows, "h"), "hot-phrases"))
    hits = hits.where(F.col("n_hosts") >= min_hosts + F.col("hosted").cast("int"))
    share = hits.groupBy("id", "host", "hosted").agg(F.sum("c").alias("hits"))
    out = pages.drop("phrases").join(share, ["id", "host", "hosted"], "left")
    per_word = {"list_density": "n_listed", "repetition": "n_repeated", "links": "n_links", "marks": "n_marks"}
    out = out.select("id", "n_words", "n_different", "hits", *[(F.col(c) / F.col("n_words")).alias(f) for f, c in per_word.items()])
    replicated = F.coalesce(F.col("hits") / (F.col("n_words") * len(lengths)), F.lit(0.0))
    sameness = F.sqrt("n_words") / F.greatest(F.col("n_different"), F.lit(1))
    out = out.withColumn("replicated", replicated).withColumn("sameness", sameness)
    out = out.withColumn("other_lists", F.col("list_density") - F.col("replicated"))
    return out.dropDuplicates(["id"]).select(F.col("id").alias(id_col), "n_words", "list_density", *FEATURES)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.03, steps: int = 50) -> np.ndarray:
    """Weights (intercept first) of a logistic model, by Newton's method. No evidence speaks against
    spam: a feature whose weight would be negative is left out (weight 0), the most negative first."""
    kept = np.arange(x.shape[1])
    while True:
        a = np.column_stack([np.ones(len(x)), x[:, kept]])
        w = np.zeros(a.shape[1])
        penalty = np.eye(a.shape[1]) * ridge
        penalty[0, 0] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            grad = a.T @ (p - y) + penalty @ w
            h = (a * (p * (1 - p))[:, None]).T @ a + penalty
            step = np.linalg.solve(h, grad)
            w -= step
            if np.abs(step).max() < 1e-8:
                break
        if not len(kept) or w[1:].min() >= 0:
            out = np.zeros(x.shape[1] + 1)
            out[0], out[kept + 1] = w[0], w[1:]
            return out
        kept = np.delete(kept, w[1:].argmin())


def fit_labels(evidence: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "is_spam", sample: int = LABEL_SAMPLE) -> np.ndarray | None:
    """Weights from at most `sample` labelled pages, chosen by a hash of their id; None where a class
    has no label."""
    l = labels.select(F.col(id_col).alias(id_col), F.col(label_col).cast("int").alias("__y")).where("__y in (0, 1)")
    l = l.groupBy(id_col).agg(F.max("__y").alias("__y"))
    rows = (
        evidence.join(l, id_col)
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(sample)
        .select("__y", *FEATURES)
        .collect()
    )
    data = np.array([[float(v) for v in r] for r in rows]).reshape(-1, 1 + len(FEATURES))
    y = data[:, 0]
    return fit(data[:, 1:], y) if len(np.unique(y)) == 2 else None


def score(weights: np.ndarray | None) -> Column:
    """Probability that a page of `page_evidence` is spam; null without weights."""
    if weights is None:
        return F.lit(None).cast("double")
    z = F.lit(float(weights[0]))
    for name, w in zip(FEATURES, weights[1:], strict=True):
        z = z + F.col(name) * F.lit(float(w))
    return 1 / (1 + F.exp(-z))


def spam_pages(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", threshold: float = 0.5) -> DataFrame:
    """(id, features, score, is_spam) of every page with words. Score and is_spam are null where the labels
    of one class are missing, as nothing can be learned then."""
    evidence = materialize(page_evidence(docs, id_col, text_col, host_col), "evidence")
    p = score(fit_labels(evidence, labels, id_col))
    return evidence.withColumn("score", p).withColumn("is_spam", F.col("score") > threshold)
