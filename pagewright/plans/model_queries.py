"""Model calls with offline proposers, request planning, embeddings and incremental runs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators import model_call as M
from pagewright.plans import pipeline
from pagewright.plans import sqltext as S
from pagewright.plans.base import chunks, doc_pages, glossary, profiles, sections
from pagewright.session import scratch_dir, table
from pagewright.streaming.incremental import emit, emitted

BUDGET = 8000


def mode_selection(spark, d):
    size = T.encoded_size(F.octet_length("text"))
    p = profiles(spark, d, "page_count").join(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return p.select("doc_id", M.mode(F.coalesce("page_count", F.lit(0)), F.coalesce(size, F.lit(0)), BUDGET).alias("mode"))


def base64_block(spark, d):
    return table(spark, d, "documents").select("doc_id", F.translate(F.base64(F.col("text").cast("binary")), "\r\n", "").alias("block"))


def context_blocks(spark, d):
    return pipeline.context_blocks(
        profiles(spark, d, "title", "doc_type", "plan_name", "sponsor", "effective_dates"),
        sections(spark, d, "doc_id", "sec_ord", "title", "section_type", "summary"),
        glossary(spark, d, "doc_id", "term_ord", "term", "definition"),
    )


def offline_outline(spark, d):
    """Reconciled sections of all documents by the rule-based proposer."""
    return pipeline.analyze(doc_pages(spark, d))[1].drop("ord")


def offline_run(spark, d):
    """The chunks of the whole pipeline with the rule-based proposer."""
    r = pipeline.run(doc_pages(spark, d))
    return r.chunks.select("doc_id", "sec_no", "chunk_index", "section_title", "page_start", "page_end", "token_count", T.content_id("chk_", F.col("text")).alias("id"))


def embed(spark, d):
    """Vectors of all different chunk texts: their length and squared norm."""
    e = chunks(spark, d, "text").select("chunk_id", M.hash_embedder()("text").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return e.select("chunk_id", F.size("v").alias("dim"), F.round(norm, 3).alias("norm"))


def incremental_emission(spark, d):
    """The chunks as a file stream in one pass, emitted batch by batch, counted per file."""
    src = table(spark, d, "chunks")
    base = f"{scratch_dir(spark)}/pagewright/stream-{uuid.uuid4().hex}"
    stream = spark.readStream.schema(src.schema).parquet(f"{d}/chunks.parque[t]")
    q = emit(stream, lambda df: df.select("chunk_id", "source_file"), f"{base}/out", f"{base}/checkpoint")
    q.awaitTermination()
    return emitted(spark, f"{base}/out").groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


_TEXT = """'DOCUMENT MAP (for context):' || {parts} || chr(10) || chr(10) || 'CURRENT SECTION:' || chr(10) || '- Title: ' || {title} || chr(10) || '- Type: ' || {kind}
 || CASE WHEN coalesce(summary, '') <> '' THEN chr(10) || '- Summary: ' || summary ELSE '' END""".format(
    parts=" || ".join(
        f"CASE WHEN coalesce({v}, '') <> '' THEN chr(10) || '- {k}: ' || {v} ELSE '' END"
        for k, v in (("Title", "p.title"), ("Type", "doc_type"), ("Plan", "plan_name"), ("Sponsor", "sponsor"), ("Effective dates", "array_to_string(effective_dates, ', ')"),
                     ("Section outline", "outline"), ("Defined terms", "terms"))
    ),
    title=f"coalesce({S.strip('s.title')}, '')",
    kind=f"coalesce({S.strip('section_type')}, '')",
)

QUERIES = {f.__name__: f for f in (mode_selection, base64_block, context_blocks, offline_outline, offline_run, embed, incremental_emission)}
SQL = {
    "mode_selection": S.BASE + f""" SELECT doc_id, CASE WHEN coalesce(page_count, 0) <= 100 AND coalesce((octet_length(encode(text)) + 2) // 3 * 4, 0) <= {BUDGET} THEN 'full' ELSE 'sliced' END AS mode FROM prof JOIN documents USING (doc_id)""",
    "base64_block": "SELECT doc_id, base64(encode(text)) AS block FROM documents",
    "context_blocks": S.BASE + f""", o AS (SELECT doc_id, string_agg(coalesce(title, ''), '; ' ORDER BY sec_ord, coalesce(title, '')) AS outline FROM sec GROUP BY doc_id),
        gl AS (SELECT doc_id, list_sort(list((term_ord, coalesce(term, ''), coalesce(definition, ''))))[1:40] AS a FROM glo GROUP BY doc_id),
        gt AS (SELECT doc_id, array_to_string(list_transform(a, lambda x: x[2] || ': ' || x[3]), '; ') AS terms FROM gl)
        SELECT s.doc_id, section_id, {_TEXT} AS context FROM sec s JOIN prof p ON p.doc_id = s.doc_id JOIN o ON o.doc_id = s.doc_id LEFT JOIN gt ON gt.doc_id = s.doc_id""",
    "embed": S.BASE + " SELECT chunk_id, 1024 AS dim, CASE WHEN len(regexp_extract_all(coalesce(text, ''), '[\\p{L}\\p{N}_]+')) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm FROM chk",
    "incremental_emission": "SELECT source_file, count(*) AS n FROM chunks GROUP BY source_file",
}
