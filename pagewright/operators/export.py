"""Export rows: typed chunk, document and glossary tables with stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.schemas import EXPORT_CHUNKS, EXPORT_DOCUMENTS, EXPORT_GLOSSARY


def document_id(source_file: Column, title: Column, whole: Column) -> Column:
    """From the source file, else the title, else the whole record."""
    key = F.coalesce(F.nullif(source_file, F.lit("")), F.nullif(title, F.lit("")), whole)
    return T.content_id("doc_", key)


def with_document_id(profiles: DataFrame) -> DataFrame:
    """Adds export_id: the id that the chunk, document and term rows of a profile share. It is computed here once, from
    the same columns, so that rows of a record without file and title agree as well."""
    if "export_id" in profiles.columns:
        return profiles
    title = F.col("title") if "title" in profiles.columns else F.lit(None).cast("string")
    source = F.col("source_file") if "source_file" in profiles.columns else F.lit(None).cast("string")
    return profiles.withColumn("export_id", document_id(source, title, F.to_json(F.struct(*sorted(profiles.columns)))))


def embedding_text(title: Column, plan: Column, source_file: Column, section: Column, summary: Column, text: Column) -> Column:
    """Document line, section line and text; the plan is added unless the title names it."""
    head = F.coalesce(F.nullif(T.clean(title), F.lit("")), F.nullif(T.clean(plan), F.lit("")), F.lit(""))
    plan, summary = T.clean(plan), T.clean(summary)
    doc = F.concat(F.lit("Document: "), F.when(head == "", T.clean(source_file)).otherwise(head))
    doc = F.concat(doc, F.when((plan != "") & ~F.contains(F.lower(head), F.lower(plan)), F.concat(F.lit(" — "), plan)).otherwise(""))
    sec = F.concat(F.lit("Section: "), T.clean(section), F.when(summary != "", F.concat(F.lit(" — "), summary)).otherwise(""))
    return T.strip(F.concat_ws("\n", doc, sec, T.clean(text)))


def _cast(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def chunk_rows(profiles: DataFrame, chunks: DataFrame) -> DataFrame:
    """One row per different text of a document, the first in chunk order; blank texts are skipped. A chunk is
    named by its file and its chunk_id, or chunk_index where there is no chunk_id.

    The duplicate check is an aggregate on (document, hash): it combines before the shuffle and moves
    no text. Adds n_copies to the export columns."""
    p = with_document_id(profiles).select("source_file", F.col("export_id").alias("doc_id"), "doc_type", "title", "plan_name", "sponsor", "effective_dates")
    name = "chunk_id" if "chunk_id" in chunks.columns else "chunk_index"
    c = chunks.withColumn("text", T.clean(F.col("text"))).where("text <> ''").join(p, "source_file")
    c = c.withColumn("id", T.content_id("chk_", F.concat("doc_id", F.lit("::"), "text")))
    first = c.groupBy("id").agg(F.min(F.struct("chunk_index", F.col(name).alias("name"), "source_file")).alias("f"), F.count(F.lit(1)).alias("n_copies"))
    first = first.select(F.col("f.source_file").alias("source_file"), F.col("f.name").alias(name), "n_copies")
    c = c.join(first, ["source_file", name])
    c = c.withColumn("embedding_text", embedding_text(*[F.col(x) for x in ("title", "plan_name", "source_file", "section_title", "section_summary", "text")]))
    for x in ("doc_type", "title", "plan_name", "sponsor", "section_title", "section_type", "section_summary"):
        c = c.withColumn(x, T.clean(F.col(x)))
    for x in ("page_start", "page_end"):
        c = c.withColumn(x, F.coalesce(F.col(x), F.lit(0)))
    for x in ("keywords", "cross_references", "effective_dates"):
        c = c.withColumn(x, F.coalesce(F.col(x), F.array().cast("array<string>")))
    return c.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EXPORT_CHUNKS.fields], "n_copies")


def document_rows(profiles: DataFrame, sections: DataFrame, glossary: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per document with its counts, sections and terms as JSON. `profiles` has doc_id as the
    tables' key; the exported doc_id is the content id."""
    s = sections.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("section_count"),
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("sec_ord", F.struct(*[T.clean(F.col(c)).alias(c) for c in ("title", "section_type", "summary")], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("page_start", "page_end")]).alias("s")))), lambda x: x["s"])).alias("sections_json"),
    )
    g = glossary.groupBy("doc_id").agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("term_ord", F.struct(*[T.clean(F.col(c)).alias(c) for c in ("term", "definition")]).alias("g")))), lambda x: x["g"])).alias("glossary_json")
    )
    n = rows.groupBy(F.col("doc_id").alias("__id")).agg(F.count(F.lit(1)).alias("chunk_count"))
    d = with_document_id(profiles).withColumnRenamed("export_id", "__id").join(s, "doc_id", "left").join(g, "doc_id", "left").join(n, "__id", "left")
    d = d.na.fill(0, ["section_count", "chunk_count"]).na.fill("[]", ["sections_json", "glossary_json"]).drop("doc_id").withColumnRenamed("__id", "doc_id")
    for x in ("source_file", "title", "doc_type", "plan_name", "sponsor", "notes"):
        d = d.withColumn(x, T.clean(F.col(x)))
    return _cast(d.withColumn("page_count", F.coalesce("page_count", F.lit(0))), EXPORT_DOCUMENTS)


def glossary_rows(profiles: DataFrame, glossary: DataFrame) -> DataFrame:
    """One row per term of a document, the first; equal without case. A term without a definition stands alone in
    its embedding text."""
    p = with_document_id(profiles).select("doc_id", F.col("export_id").alias("__id"))
    g = glossary.withColumn("term", T.clean(F.col("term"))).withColumn("definition", T.clean(F.col("definition"))).where("term <> ''").join(p, "doc_id")
    g = g.withColumn("id", T.content_id("gls_", F.concat("__id", F.lit("::"), F.lower("term"))))
    f = g.groupBy("id").agg(F.min_by(F.struct(F.col("__id").alias("doc_id"), "term", "definition"), F.struct("term_ord", "term_id")).alias("r"))
    f = f.select("id", "r.*").withColumn("embedding_text", F.when(F.col("definition") == "", F.col("term")).otherwise(F.concat("term", F.lit(": "), "definition")))
    return _cast(f, EXPORT_GLOSSARY)


def upsert(current: DataFrame, incoming: DataFrame, key: str = "id", doc: str = "doc_id", embedding: str = "embedding", guard: str = "embedding_text") -> DataFrame:
    """The next version of `current`: rows of `incoming` replace or join it; rows of the incoming
    documents that `incoming` doesn't hold are deleted; other documents stay. An embedding is kept
    unless its text changed. One full outer join on the key and one semi-join on the document.

    For tables without row-level operations; the result is written as a new version."""
    i = incoming.select(F.col(key), F.struct(*[F.col(c) for c in incoming.columns]).alias("i"))
    t = current.select(F.col(key), F.struct(*[F.col(c) for c in current.columns]).alias("t"))
    docs = incoming.select(F.col(doc).alias("__d")).distinct().withColumn("__in", F.lit(True))
    j = t.join(i, key, "full_outer").withColumn("__d", F.col("t")[doc])
    j = j.join(docs, "__d", "left").where(F.col("i").isNotNull() | F.col("__in").isNull())
    out = []
    for f in current.schema.fields:
        c = f.name
        if c == key:
            out.append(F.col(key))
        elif c == embedding:
            changed = F.coalesce(F.col("t")[guard] != F.col("i")[guard], F.lit(False)) if guard in incoming.columns else F.lit(False)
            out.append(F.when(F.col("i").isNull() | ~changed, F.col("t")[c]).alias(c))
        elif c in incoming.columns:
            out.append(F.when(F.col("i").isNull(), F.col("t")[c]).otherwise(F.col("i")[c]).alias(c))
        else:
            out.append(F.col("t")[c].alias(c))
    return j.select(*out)


def pending_embeddings(rows: DataFrame, embedding: str = "embedding") -> DataFrame:
    return rows.where(F.col(embedding).isNull())
