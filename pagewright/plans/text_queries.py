"""Text functions over the whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.plans import sqltext as S
from pagewright.plans.base import chunks, profiles, sections
from pagewright.session import spread, table


def _docs(spark, d):
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def match_key(spark, d):
    return _docs(spark, d).select("doc_id", T.match_key(F.col("text")).alias("match_key"))


def token_count(spark, d):
    return _docs(spark, d).select("doc_id", T.token_count(F.col("text")).alias("token_count"))


def ascii_token_count(spark, d):
    return chunks(spark, d, "text").select("chunk_id", T.ascii_token_count(F.col("text")).alias("token_count"))


def dedup_key(spark, d):
    return chunks(spark, d, "text").select("chunk_id", T.dedup_key(F.col("text")).alias("dedup_key"))


def dot_leaders(spark, d):
    return _docs(spark, d).select("doc_id", T.strip_dot_leaders(F.col("text")).alias("text"))


def toc_detect(spark, d):
    """Pages that are contents lists."""
    from pagewright.plans.base import doc_pages

    return doc_pages(spark, d).where(T.is_toc_text(F.col("text"))).select("doc_id", "page_no")


def sentences(spark, d):
    s = _docs(spark, d).select("doc_id", F.posexplode_outer(T.sentences(F.col("text"))).alias("pos", "sentence")).where("pos is not null")
    return s.select("doc_id", "pos", "sentence")


def paragraphs(spark, d):
    s = _docs(spark, d).select("doc_id", F.posexplode_outer(T.paragraphs(F.col("text"))).alias("pos", "paragraph")).where("pos is not null")
    return s.select("doc_id", "pos", "paragraph")


def content_id(spark, d):
    return _docs(spark, d).select("doc_id", T.content_id("chk_", F.col("text")).alias("content_id"))


def clean_string(spark, d):
    return profiles(spark, d, "plan_name", "sponsor").select(
        "doc_id", T.clean(F.col("plan_name")).alias("plan_name"), T.clean(F.col("sponsor")).alias("sponsor")
    )


def word_bag(spark, d):
    """Words of each document with their number."""
    w = _docs(spark, d).select("doc_id", F.explode_outer(T.words(F.col("text"))).alias("word")).where("word is not null")
    return w.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def title_key(spark, d):
    return sections(spark, d, "title").select("section_id", T.normalize_title(F.col("title")).alias("title_key"))


def distinct_keywords(spark, d):
    return chunks(spark, d, "keywords").select("chunk_id", F.array_join(T.distinct_in_order(F.col("keywords")), "|").alias("keywords"))


def encoded_size(spark, d):
    return _docs(spark, d).select("doc_id", T.encoded_size(F.octet_length("text")).alias("encoded_size"))


_SENT = f"(SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda x: {S.strip('x')}), lambda x: x <> '') AS a FROM documents)"
_PARA = "(SELECT doc_id, regexp_split_to_array(text, '\\n\\s*\\n') AS a FROM documents)"

QUERIES = {
    f.__name__: f
    for f in (
        match_key, token_count, ascii_token_count, dedup_key, dot_leaders, toc_detect, sentences, paragraphs, content_id,
        clean_string, word_bag, title_key, distinct_keywords, encoded_size,
    )
}
SQL = {
    "match_key": f"SELECT doc_id, {S.match_key('text')} AS match_key FROM documents",
    "token_count": f"SELECT doc_id, {S.tokens('text')} AS token_count FROM documents",
    "ascii_token_count": S.BASE + f" SELECT chunk_id, {S.size_of(S.count('text', '[A-Za-z0-9_]+|[^A-Za-z0-9_' + chr(92) + 's' + chr(92) + 'x0b' + chr(92) + 'x{85}' + chr(92) + 'p{Z}' + chr(92) + 'x{feff}]'))} AS token_count FROM chk",
    "dedup_key": S.BASE + f" SELECT chunk_id, {S.dedup_key('text')} AS dedup_key FROM chk",
    "dot_leaders": f"SELECT doc_id, {S.leaders('text')} AS text FROM documents",
    "toc_detect": f"WITH {S.PAGES} SELECT doc_id, page_no FROM pages WHERE {S.is_toc('text')}",
    "sentences": f"SELECT doc_id, CAST(unnest(range(0, len(a))) AS INTEGER) AS pos, unnest(a) AS sentence FROM {_SENT}",
    "paragraphs": f"SELECT doc_id, CAST(unnest(range(0, len(a))) AS INTEGER) AS pos, unnest(a) AS paragraph FROM {_PARA}",
    "content_id": f"SELECT doc_id, {S.content_id('chk_', 'text')} AS content_id FROM documents",
    "clean_string": S.BASE + f" SELECT doc_id, coalesce({S.strip('plan_name')}, '') AS plan_name, coalesce({S.strip('sponsor')}, '') AS sponsor FROM prof",
    "word_bag": f"SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest({S.words('text')}) AS word FROM documents) GROUP BY ALL",
    "title_key": S.BASE + f" SELECT section_id, {S.title_key('title')} AS title_key FROM sec",
    "distinct_keywords": S.BASE + ", u AS (SELECT chunk_id, keywords, unnest(keywords) AS k, generate_subscripts(keywords, 1) AS i FROM chk), "
    "f AS (SELECT chunk_id, k, min(i) AS i FROM u GROUP BY chunk_id, k), g AS (SELECT chunk_id, string_agg(k, '|' ORDER BY i) AS ks FROM f GROUP BY chunk_id) "
    "SELECT chk.chunk_id, CASE WHEN keywords IS NULL THEN NULL ELSE coalesce(ks, '') END AS keywords FROM chk LEFT JOIN g USING (chunk_id)",
    "encoded_size": "SELECT doc_id, CAST(floor((octet_length(encode(text)) + 2) / 3) AS BIGINT) * 4 AS encoded_size FROM documents",
}
