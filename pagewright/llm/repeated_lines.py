"""Lines repeated across the documents of one source.

A document is the sequence of its line identifiers (the letters of the line, one case, hashed
together with the source). Frequent sequences are mined by PrefixSpan over all sources at once:
frequent single lines first; the documents are projected on them; then every frequent prefix grows by
the line that follows its occurrences there, as long as enough different documents of the source hold the
result. Own lines between repeated ones are skipped that way, repeated ones are not: each part of a
frequent sequence is frequent itself, so skipping them would list exponentially many patterns and cover
no further line. Every level is one written table of (document, position, pattern) rows: no level's plan holds
the levels before it, and mining ends with the first level without a frequent pattern. Hot lines meet
their support by a bounded broadcast.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.operators.skew import FLOOR, MAX_HOT
from pagewright.session import materialize

MIN_DOCS = 8


def line_key(source: Column, line: Column) -> Column:
    """16-byte identity of a line in its source: letters only, without case; null without letters."""
    letters = F.lower(F.regexp_replace(line, r"[^\p{L}]+", ""))
    # letters whose capital form is another one: the sharp s and the final sigma
    letters = F.replace(F.replace(letters, F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))
    key = F.unhex(F.md5(F.concat(source, F.lit("\x01"), letters).cast("binary")))
    return F.when(F.length(letters) > 0, key)


def lines_of(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """(id, line_no, ord, key): one row per line with letters. line_no counts all lines from 1,
    ord only lines with letters."""
    d = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    d = d.where("id is not null and source is not null and text is not null")
    d = d.select("id", "source", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return d.select("id", (F.col("pos") + 1).alias("line_no"), line_key(F.col("source"), F.col("line")).alias("key")).where("key is not null")


def _support(occ: DataFrame, key: str, min_docs: int) -> DataFrame:
    """(key, docs): different ids per key, for keys with at least `min_docs`. Two levels: the
    distinct step spreads a hot key by id, the count combines before its shuffle."""
    return occ.select(key, "id").distinct().groupBy(key).agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs)


def _keep_frequent(occ: DataFrame, support: DataFrame, key: str, floor: int, max_hot: int) -> DataFrame:
    """The occurrences whose key is in `support`; the hottest keys by a bounded broadcast."""
    hot = support.where(F.col("docs") >= floor).orderBy(F.desc("docs"), key).limit(max_hot).select(key)
    hot_b = F.broadcast(hot)
    cold = support.join(hot_b, key, "left_anti").select(key)
    return occ.join(hot_b, key, "left_semi").unionByName(occ.join(hot_b, key, "left_anti").join(cold, key, "left_semi"))


def frequent_sequences(
    docs: DataFrame,
    id_col: str = "chunk_id",
    source_col: str = "source_file",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    floor: int = FLOOR,
    max_hot: int = MAX_HOT,
) -> tuple[DataFrame, DataFrame]:
    """Returns

    - occurrences (id, line_no, length): the lines covered by an occurrence of a frequent sequence and
      the length of the longest such sequence that begins there; rows delivered again (same id) count once,
    - sequences (key, length, docs): the frequent sequences with the number of their documents.

    Null ids, sources and texts take no part; empty texts have no lines; a source with fewer than
    `min_docs` documents has no frequent sequence. A line that occurs twice in a document counts
    once for support, and both occurrences are covered.
    """
    lines = materialize(lines_of(docs, id_col, source_col, text_col), "lines")
    support = materialize(_support(lines, "key", min_docs), "line-support")
    level = _keep_frequent(lines, support, "key", floor, max_hot).groupBy("id", "line_no").agg(F.first("key").alias("key"))
    in_order = Window.partitionBy("id").orderBy("line_no")
    level = materialize(level.withColumn("at", F.row_number().over(in_order)), "level-1")
    starts, sequences = [level.select("id", "line_no", F.lit(1).alias("length"))], [support.select("key", F.lit(1).alias("length"), "docs")]
    follows = Window.partitionBy("id").orderBy("at")
    for length in count(2):
        # two overlapping frequent sequences of the level before: prefix and suffix of the grown one
        grown = level.select(
            "id", "line_no", "at", F.when(F.lead("at").over(follows) == F.col("at") + 1, F.concat("key", F.lead("key").over(follows))).alias("pair")
        ).where("pair is not null")
        grown = materialize(grown.select("id", "line_no", "at", F.unhex(F.md5("pair")).alias("key")), f"grown-{length}")
        support = materialize(_support(grown, "key", min_docs), f"support-{length}")
        if support.isEmpty():
            break
        level = materialize(_keep_frequent(grown, support, "key", floor, max_hot), f"level-{length}")
        starts.append(level.select("id", "line_no", F.lit(length).alias("length")))
        sequences.append(support.select("key", F.lit(length).alias("length"), "docs"))
    occurrences = reduce(DataFrame.unionByName, starts).groupBy("id", "line_no").agg(F.max("length").alias("length"))
    return occurrences, reduce(DataFrame.unionByName, sequences)


def strip_repeated(docs: DataFrame, occurrences: DataFrame, id_col: str = "chunk_id", text_col: str = "text") -> DataFrame:
    """(id, own_text, n_removed) of every row of `docs`: its text without the covered lines. Null
    texts stay null; a text of repeated lines only becomes empty."""
    gone = occurrences.groupBy("id").agg(F.collect_set("line_no").alias("gone"))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(gone, "id", "left")
    own = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("gone", i + 1)), "\n")
    )
    return d.select(F.col("id").alias(id_col), own.alias("own_text"), F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))
