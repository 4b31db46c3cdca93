"""Export tables, upsert, retrieval, curation and run state over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.operators import curate as C
from pagewright.operators import export as X
from pagewright.operators import retrieve as R
from pagewright.plans import sqltext as S
from pagewright.plans.base import chunks, glossary, profiles, sections
from pagewright.session import table

_PROFILE = ("source_file", "title", "doc_type", "plan_name", "sponsor", "effective_dates")
_CHUNK = ("source_file", "chunk_index", "text", "section_title", "section_type", "section_summary", "page_start", "page_end", "keywords", "cross_references", "token_count")


def doc_id(spark, d):
    p = profiles(spark, d, *_PROFILE)
    return p.select("doc_id", X.document_id(F.col("source_file"), F.col("title"), F.to_json(F.struct("source_file", "title"))).alias("export_id"))


def _rows(spark, d):
    return X.chunk_rows(profiles(spark, d, *_PROFILE), chunks(spark, d, *_CHUNK))


def embedding_text(spark, d):
    return _rows(spark, d).select("id", "embedding_text")


def chunk_rows(spark, d):
    r = _rows(spark, d)
    lists = [F.array_join(c, "|").alias(c) for c in ("effective_dates", "keywords", "cross_references")]
    return r.select(*[c for c in r.columns if c not in ("effective_dates", "keywords", "cross_references")], *lists)


def document_rows(spark, d):
    r = X.document_rows(
        profiles(spark, d, *_PROFILE, "page_count", "cross_references", "notes"),
        sections(spark, d, "doc_id", "sec_ord", "title", "section_type", "summary", "page_start", "page_end"),
        glossary(spark, d, "doc_id", "term_ord", "term", "definition"),
        _rows(spark, d),
    )
    return r.select("doc_id", "source_file", "title", "doc_type", "plan_name", "sponsor", "page_count", "section_count", "chunk_count", "sections_json", "glossary_json", "notes")


def glossary_rows(spark, d):
    return X.glossary_rows(profiles(spark, d, *_PROFILE), glossary(spark, d, "doc_id", "term_ord", "term", "definition"))


def _versions(spark, d):
    g = glossary(spark, d, "doc_id", "term", "definition").select(F.col("term_id").alias("id"), "doc_id", F.concat_ws(": ", "term", "definition").alias("embedding_text"))
    # the whole table as it first came meets all rows delivered again, with what changed since
    now = g.withColumn("embedding", F.col("id") * 2)
    new = table(spark, d, "glossary").groupBy("term_id").agg(F.max_by(F.struct("doc_id", "term", "definition"), F.struct("loaded_at", "term", "definition")).alias("r"))
    new = new.select(F.col("term_id").alias("id"), "r.doc_id", F.concat_ws(": ", F.trim("r.term"), "r.definition").alias("embedding_text"))
    return now, new.where("id is not null")


def merge_upsert(spark, d):
    return X.upsert(*_versions(spark, d))


def pending_embeddings(spark, d):
    return X.pending_embeddings(merge_upsert(spark, d)).select("id", "doc_id")


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def vector_topk(spark, d):
    v = _vectors(spark, d)
    return R.vector_topk(v, v.where("id % 20 = 0"), 5).select("query_id", "rank", "id")


def filtered_topk(spark, d):
    v = _vectors(spark, d)
    return R.vector_topk(v, v.where("id % 20 = 0"), 5, filters={"label >=": 3, "label !=": 5}).select("query_id", "rank", "id")


def index_topk(spark, d):
    """Approximate search: every row is indexed, the fit is on a bounded sample."""
    v = _vectors(spark, d)
    x = R.sampled(v)
    c = R.fit_index(v, x=x)
    return R.index_topk(R.assign_cells(v, c), v.where("id % 20 = 0"), c, 5, probes=R.probes_for(v, c, 5, x=x)).select("query_id", "rank", "id")


def hybrid_topk(spark, d):
    docs = table(spark, d, "documents").select((F.col("doc_id") - 1001).alias("id"), "text").where("text is not null")
    v = _vectors(spark, d)
    q = docs.where("id % 20 = 0").select("id", F.col("text").alias("query"))
    return R.hybrid_search(v, v.where("id % 20 = 0"), docs, q, 5).select("query_id", "rank", "id")


def text_filter(spark, d):
    return C.text_filter(chunks(spark, d, "text", "keywords", "section_title"), "pension").select("chunk_id")


def _decisions(spark, d):
    c = chunks(spark, d, "text").where("chunk_id % 7 = 0 or chunk_id % 11 = 0")
    return c.select("chunk_id", (F.col("chunk_id") % 7 != 0).alias("inc"), F.when(F.col("chunk_id") % 11 == 0, F.upper("text")).alias("new_text"))


def section_counts(spark, d):
    c = chunks(spark, d, "source_file", "section_title").withColumn("inc", F.col("chunk_id") % 3 != 0)
    return C.section_counts(c, ["source_file", "section_title"])


def token_stats(spark, d):
    return C.token_stats(chunks(spark, d, "source_file", "token_count"), ["source_file"])


def curated_export(spark, d):
    return C.curated_export(chunks(spark, d, "text", "token_count"), _decisions(spark, d), ["chunk_id"]).select("chunk_id", "text", "token_count", "edited")


def curated_gate(spark, d):
    return C.curated_gate(table(spark, d, "chunk_lines")).select("line_id", "ok")


def over_limit(spark, d):
    return C.over_limit(chunks(spark, d, "text"), 1024).select("chunk_id", "token_count")


def _state(spark, d):
    """Sections and chunks of the mapped files; chunks of titles of four letters in seven are missing."""
    p = profiles(spark, d, "source_file")
    s = sections(spark, d, "doc_id", "sec_ord", "title").select("doc_id", F.coalesce("title", F.lit("")).alias("title"), (F.row_number().over(_by_doc()) - 1).cast("int").alias("ord"))
    c = chunks(spark, d, "source_file", "chunk_index", "section_title").join(p.select("doc_id", "source_file"), "source_file").where("section_title is not null")
    return s, c


def _by_doc():
    from pyspark.sql import Window

    return Window.partitionBy("doc_id").orderBy("sec_ord", "section_id")


def completed_prefix(spark, d):
    return C.completed_prefix(*_state(spark, d), "doc_id")


def resume_plan(spark, d):
    return C.resume_plan(*_state(spark, d), "doc_id").select("doc_id", "chunk_id", "chunk_index")


_COUNTERS = ["input_tokens", "output_tokens"]


def _usage(spark, d):
    v = F.floor("value").cast("bigint")
    log = table(spark, d, "events").select(F.col("event_type").alias("model"), v.alias("input_tokens"), F.floor(F.col("value") / 2).cast("bigint").alias("output_tokens"))
    return C.usage_totals(log, _COUNTERS)


def usage_totals(spark, d):
    return _usage(spark, d)


def usage_cost(spark, d):
    rates = spark.createDataFrame([("c", 1, 1.0, 5.0), ("cl", 2, 2.0, 9.0), ("", 3, 3.0, 15.0)], "prefix string, ord int, rate_input_tokens double, rate_output_tokens double")
    return C.usage_cost(_usage(spark, d), rates, _COUNTERS)


def job_listing(spark, d):
    """One job per output file, from its lines."""
    j = table(spark, d, "chunk_lines").groupBy(F.col("run_file").alias("job_id")).agg(F.min("read_at").alias("created_at"), F.count(F.lit(1)).alias("lines"))
    return C.job_listing(j).select("job_id", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"), "lines")


QUERIES = {
    f.__name__: f
    for f in (
        doc_id, embedding_text, chunk_rows, document_rows, glossary_rows, merge_upsert, pending_embeddings, vector_topk, filtered_topk,
        index_topk, hybrid_topk, text_filter, section_counts, token_stats, curated_export, curated_gate, over_limit, completed_prefix,
        resume_plan, usage_totals, usage_cost, job_listing,
    )
}


def _clean(x: str) -> str:
    return f"coalesce({S.strip(x)}, '')"


_HEAD = f"coalesce(nullif({_clean('title')}, ''), nullif({_clean('plan_name')}, ''), '')"
_ET = (
    f"{S.strip(f'''('Document: ' || CASE WHEN {_HEAD} = '' THEN {_clean('source_file')} ELSE {_HEAD} END || CASE WHEN {_clean('plan_name')} <> '' AND NOT contains(lower({_HEAD}), lower({_clean('plan_name')})) THEN ' — ' || {_clean('plan_name')} ELSE '' END || chr(10) || 'Section: ' || {_clean('section_title')} || CASE WHEN {_clean('section_summary')} <> '' THEN ' — ' || {_clean('section_summary')} ELSE '' END || chr(10) || text)''')}"
)
_CR = S.BASE + f""", pr AS (SELECT source_file, doc_type, title, plan_name, sponsor, effective_dates, {S.content_id('doc_', 'source_file')} AS doc_id FROM prof),
cc AS (SELECT chk.* EXCLUDE (text), {_clean('text')} AS text FROM chk WHERE {_clean('text')} <> ''),
ci AS (SELECT cc.*, pr.* EXCLUDE (source_file), {S.content_id('chk_', "(pr.doc_id || '::' || text)")} AS id FROM cc JOIN pr USING (source_file)),
cr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY chunk_index, chunk_id) AS rn, count(*) OVER (PARTITION BY id) AS n_copies FROM ci),
rows_ AS (SELECT id, doc_id, source_file, text, {_ET} AS embedding_text, {', '.join(f'{_clean(x)} AS {x}' for x in ('doc_type', 'title', 'plan_name', 'sponsor', 'section_title', 'section_type', 'section_summary'))},
 coalesce(page_start, 0) AS page_start, coalesce(page_end, 0) AS page_end, token_count, n_copies,
 {', '.join(f"coalesce(array_to_string({x}, '|'), '') AS {x}" for x in ('effective_dates', 'keywords', 'cross_references'))} FROM cr WHERE rn = 1)"""
_VER = S.BASE + """, g AS (SELECT term_id AS id, doc_id, concat_ws(': ', term, definition) AS embedding_text FROM glo),
t AS (SELECT *, id * 2 AS embedding FROM g),
l AS (SELECT *, row_number() OVER (PARTITION BY term_id ORDER BY loaded_at DESC, term DESC, definition DESC) AS rn FROM glossary WHERE term_id IS NOT NULL),
i AS (SELECT term_id AS id, doc_id, concat_ws(': ', trim(term), definition) AS embedding_text FROM l WHERE rn = 1),
m AS (SELECT i.id, i.doc_id, i.embedding_text, CASE WHEN t.embedding_text <> i.embedding_text THEN NULL ELSE t.embedding END AS embedding FROM i LEFT JOIN t USING (id)
 UNION ALL SELECT * FROM t WHERE id NOT IN (SELECT id FROM i) AND doc_id NOT IN (SELECT doc_id FROM i))"""


def _near(where: str, k: int) -> str:
    return f"""(SELECT query_id, id, CAST(rank AS INTEGER) AS rank FROM (SELECT q.vec_id AS query_id, v.vec_id AS id,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) DESC, v.vec_id) AS rank
        FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0 AND {where}) WHERE rank <= {k})"""


_ST = S.BASE + """, ss AS (SELECT doc_id, coalesce(title, '') AS title, row_number() OVER (PARTITION BY doc_id ORDER BY sec_ord, section_id) - 1 AS ord FROM sec),
sc AS (SELECT chk.*, prof.doc_id FROM chk JOIN prof USING (source_file) WHERE section_title IS NOT NULL),
sm AS (SELECT ss.*, EXISTS (SELECT 1 FROM sc WHERE sc.doc_id = ss.doc_id AND sc.section_title = ss.title) AS h FROM ss),
sp AS (SELECT doc_id, CAST(coalesce(min(ord) FILTER (WHERE NOT h), count(*)) AS INTEGER) AS done FROM sm GROUP BY doc_id)"""
_US = """SELECT event_type AS model, CAST(coalesce(sum(CAST(floor(value) AS BIGINT)), 0) AS BIGINT) AS input_tokens,
 CAST(coalesce(sum(CAST(floor(value / 2) AS BIGINT)), 0) AS BIGINT) AS output_tokens, count(value) AS calls FROM events GROUP BY event_type"""
SQL = {
    "doc_id": S.BASE + f" SELECT doc_id, {S.content_id('doc_', 'source_file')} AS export_id FROM prof",
    "embedding_text": _CR + " SELECT id, embedding_text FROM rows_",
    "chunk_rows": _CR + " SELECT * FROM rows_",
    "document_rows": _CR + f""", sj AS (SELECT doc_id, count(*) AS n, CAST(to_json(list(struct_pack(title := {_clean('title')}, section_type := {_clean('section_type')}, summary := {_clean('summary')}, page_start := coalesce(page_start, 0), page_end := coalesce(page_end, 0)) ORDER BY sec_ord, {_clean('title')}, {_clean('section_type')}, {_clean('summary')}, coalesce(page_start, 0), coalesce(page_end, 0))) AS VARCHAR) AS j FROM sec GROUP BY doc_id),
        gj AS (SELECT doc_id, CAST(to_json(list(struct_pack(term := {_clean('term')}, definition := {_clean('definition')}) ORDER BY term_ord, {_clean('term')}, {_clean('definition')})) AS VARCHAR) AS j FROM glo GROUP BY doc_id),
        n AS (SELECT doc_id, count(*) AS n FROM rows_ GROUP BY doc_id)
        SELECT {S.content_id('doc_', 'source_file')} AS doc_id, source_file, {', '.join(f'{_clean(x)} AS {x}' for x in ('title', 'doc_type', 'plan_name', 'sponsor', 'notes'))}, coalesce(page_count, 0) AS page_count,
        CAST(coalesce(sj.n, 0) AS INTEGER) AS section_count, CAST(coalesce(n.n, 0) AS INTEGER) AS chunk_count, coalesce(sj.j, '[]') AS sections_json, coalesce(gj.j, '[]') AS glossary_json
        FROM prof LEFT JOIN sj ON sj.doc_id = prof.doc_id LEFT JOIN gj ON gj.doc_id = prof.doc_id LEFT JOIN n ON n.doc_id = {S.content_id('doc_', 'source_file')}""",
    "glossary_rows": S.BASE + f""", p AS (SELECT doc_id, {S.content_id('doc_', 'source_file')} AS xid FROM prof),
        g AS (SELECT xid AS doc_id, {_clean('term')} AS term, {_clean('definition')} AS definition, term_ord, term_id FROM glo JOIN p USING (doc_id) WHERE {_clean('term')} <> ''),
        i AS (SELECT *, {S.content_id('gls_', "(doc_id || '::' || CASE WHEN regexp_matches(term, 'Σ$|Σ[^' || chr(92) || 'p{L}]') THEN regexp_replace(lower(term), 'σ($|[^' || chr(92) || 'p{L}])', 'ς' || chr(92) || '1', 'g') ELSE lower(term) END)").replace("' || chr(92) || '", chr(92))} AS id FROM g),
        r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY term_ord, term_id) AS rn FROM i)
        SELECT id, doc_id, term, definition, term || CASE WHEN definition = '' THEN '' ELSE ': ' || definition END AS embedding_text FROM r WHERE rn = 1""",
    "merge_upsert": _VER + " SELECT * FROM m",
    "pending_embeddings": _VER + " SELECT id, doc_id FROM m WHERE embedding IS NULL",
    "vector_topk": f"SELECT * FROM {_near('true', 5)}",
    "filtered_topk": f"SELECT * FROM {_near('v.label >= 3 AND v.label <> 5', 5)}",
    "hybrid_topk": f"""WITH dd AS (SELECT doc_id - 1001 AS id, text FROM documents WHERE text IS NOT NULL), n AS (SELECT count(*) AS n FROM dd),
        dw AS (SELECT DISTINCT id, unnest({S.words('text', 4)}) AS word FROM dd),
        qw AS (SELECT DISTINCT id AS query_id, unnest({S.words('text', 4)}) AS word FROM dd WHERE id % 20 = 0),
        wt AS (SELECT word, CAST(round(1000.0::DOUBLE * ln(1.0::DOUBLE + (SELECT n FROM n)::DOUBLE / count(*))) AS BIGINT) AS w FROM dw GROUP BY word),
        ks AS (SELECT query_id, id, sum(w) AS s FROM dw JOIN qw USING (word) JOIN wt USING (word) GROUP BY ALL),
        kr AS (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM ks),
        b AS (SELECT query_id, id, rank FROM {_near('true', 10**9)} UNION ALL SELECT query_id, id, rank FROM kr),
        f AS (SELECT query_id, id, sum(1.0::DOUBLE / (rank + 60)) AS s FROM b GROUP BY ALL)
        SELECT query_id, id, CAST(rank AS INTEGER) AS rank FROM (SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM f) WHERE rank <= 5""",
    "text_filter": S.BASE + " SELECT chunk_id FROM chk WHERE contains(lower(coalesce(text, '') || ' ' || coalesce(array_to_string(keywords, ' '), '') || ' ' || coalesce(section_title, '')), 'pension')",
    "section_counts": S.BASE + """, c AS (SELECT source_file, section_title, count(*) AS chunks, count(*) FILTER (WHERE chunk_id % 3 <> 0) AS included FROM chk GROUP BY ALL)
        SELECT *, CASE WHEN included = chunks THEN 'checked' WHEN included > 0 THEN 'indeterminate' ELSE 'empty' END AS state FROM c""",
    "token_stats": S.BASE + """, s AS (SELECT source_file, list_sort(list(token_count)) AS a FROM chk WHERE token_count > 0 GROUP BY source_file)
        SELECT source_file, a[len(a) // 2 + 1] AS median_tokens, a[1] AS min_tokens, a[-1] AS max_tokens FROM s""",
    "curated_export": S.BASE + f""", e AS (SELECT chunk_id, chunk_id % 11 = 0 AND text IS NOT NULL AS edited, CASE WHEN chunk_id % 11 = 0 THEN upper(text) ELSE text END AS text, token_count FROM chk WHERE chunk_id % 7 <> 0)
        SELECT chunk_id, replace(text, 'ẞ', 'SS') AS text, CASE WHEN edited THEN {S.size_of(S.count("replace(text, 'ẞ', 'SS')", '[A-Za-z0-9_]+|[^A-Za-z0-9_' + chr(92) + 's' + chr(92) + 'x0b' + chr(92) + 'x{85}' + chr(92) + 'p{Z}' + chr(92) + 'x{feff}]'))} ELSE token_count END AS token_count, edited FROM e""",
    "curated_gate": "SELECT line_id, CASE WHEN json_valid(raw) AND json_type(raw) = 'OBJECT' THEN json_exists(raw, '$.text') ELSE false END AS ok FROM chunk_lines",
    "over_limit": S.BASE + f" SELECT chunk_id, {S.tokens('text')} AS token_count FROM chk WHERE {S.tokens('text')} > 1024",
    "completed_prefix": _ST + " SELECT * FROM sp",
    "resume_plan": _ST + """, k AS (SELECT DISTINCT ss.doc_id, title FROM ss JOIN sp USING (doc_id) WHERE ord < done)
        SELECT sc.doc_id, chunk_id, CAST(row_number() OVER (PARTITION BY sc.doc_id ORDER BY chunk_index) - 1 AS INTEGER) AS chunk_index FROM sc JOIN k ON k.doc_id = sc.doc_id AND k.title = sc.section_title""",
    "usage_totals": _US,
    "usage_cost": f"""WITH u AS ({_US}), r AS (SELECT *, CASE WHEN starts_with(model, 'c') THEN 1.0 ELSE 3.0 END AS a, CASE WHEN starts_with(model, 'c') THEN 5.0 ELSE 15.0 END AS b FROM u)
        SELECT sum(CAST((input_tokens * a + output_tokens * b) AS DOUBLE) / 1000000) AS cost FROM r""",
    "job_listing": "SELECT run_file AS job_id, strftime(min(read_at), '%Y-%m-%d %H:%M:%S') AS created_at, count(*) AS lines FROM chunk_lines GROUP BY run_file",
}
