"""Page ranges and document maps over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.operators import outline as O
from pagewright.operators import pages as P
from pagewright.plans import sqltext as S
from pagewright.plans.base import chunks, doc_pages, glossary, profiles, sections

BUDGET = 4000
MAX_PAGES, OVERLAP = 20, 2


def page_count(spark, d):
    return doc_pages(spark, d).groupBy("doc_id").agg(F.max("page_no").alias("page_count"))


def text_layer(spark, d):
    return doc_pages(spark, d)


def plan_batches(spark, d):
    b = P.plan_batches(profiles(spark, d, "page_count"), "page_count", MAX_PAGES, OVERLAP)
    return b.select("doc_id", "batch_no", "page_start", "page_end")


def slice_pages(spark, d):
    """The pages of every planned batch of every document."""
    ranges = P.plan_batches(page_count(spark, d), "page_count", 4, 1).select("doc_id", "batch_no", "page_start", "page_end")
    return P.slice_pages(doc_pages(spark, d), ranges).select("doc_id", "batch_no", "page_no", "text")


def _page_ranges(spark, d):
    return page_count(spark, d).withColumn("page_start", F.lit(1)).withColumn("page_end", F.col("page_count"))


def slice_to_fit(spark, d):
    s = P.slice_to_fit(doc_pages(spark, d), _page_ranges(spark, d), BUDGET)
    return s.select("doc_id", "slice_no", "slice_start", "slice_end", "fits")


def iter_batches(spark, d):
    s = P.iter_batches(doc_pages(spark, d), page_count(spark, d), BUDGET, 4, 1)
    return s.select("doc_id", "batch_no", "slice_start", "slice_end", "fits")


def rebase_pages(spark, d):
    s = sections(spark, d, "page_start", "page_end", "sec_ord").withColumn("page_offset", F.col("sec_ord") * 2)
    return P.rebase(s, "page_offset").select("section_id", "page_start", "page_end")


def first_nonempty(spark, d):
    c = chunks(spark, d, "source_file", "chunk_index", "section_title", "section_type", "section_summary")
    return O.first_nonempty(c, "source_file", "chunk_index", ["section_title", "section_type", "section_summary"], {"section_type": "unknown"})


def dedupe_strings(spark, d):
    c = chunks(spark, d, "source_file", "chunk_index", "keywords")
    k = c.select("source_file", "chunk_index", F.posexplode("keywords").alias("pos", "keyword"))
    return O.dedupe_strings(k, "source_file", "keyword", ["chunk_index", "pos"]).select("source_file", "keyword", "chunk_index", "pos")


def sanitize_refs(spark, d):
    c = profiles(spark, d, "cross_references").select("doc_id", F.posexplode("cross_references").alias("pos", "ref"))
    return O.sanitize_references(c, "doc_id", "ref", ["pos"]).select("doc_id", "pos", "ref")


def merge_glossary(spark, d):
    return O.merge_glossary(glossary(spark, d, "doc_id", "term_ord", "term", "definition")).select("doc_id", "term", "definition")


def _sections(spark, d):
    return sections(spark, d, "doc_id", "sec_ord", "title", "section_type", "summary", "page_start", "page_end").withColumnRenamed("sec_ord", "ord")


def merge_sections(spark, d):
    return O.merge_sections(O.repair_ranges(_sections(spark, d)))


def fill_gaps(spark, d):
    return O.fill_gaps(O.repair_ranges(_sections(spark, d)), profiles(spark, d, "page_count")).drop("summary")


def reconcile(spark, d):
    return O.reconcile(_sections(spark, d), profiles(spark, d, "page_count"))


def shared_pages(spark, d):
    return O.shared_pages(reconcile(spark, d)).select("doc_id", "sec_no", "shared")


_REP = """rp AS (SELECT section_id, doc_id, sec_ord AS ord, title, section_type, summary,
  coalesce(page_start, page_end, 1) AS page_start,
  greatest(coalesce(page_end, page_start, 1), coalesce(page_start, page_end, 1)) AS page_end FROM sec)"""
_MERGE = f"""{_REP},
mk AS (SELECT *, coalesce({S.title_key('title')}, '') AS tk FROM rp),
mr AS (SELECT *, max(page_end) OVER (PARTITION BY doc_id, tk ORDER BY page_start, page_end, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM mk),
mi AS (SELECT *, sum(CASE WHEN reach IS NULL OR page_start > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, tk ORDER BY page_start, page_end, ord) AS run FROM mr),
mg AS (SELECT doc_id, arg_min(struct_pack(t := title), (page_start, page_end, ord)).t AS title,
  arg_min(struct_pack(t := section_type), (page_start, page_end, ord)).t AS section_type,
  arg_min(struct_pack(t := summary), (-length(coalesce(summary, '')), page_start, page_end, ord)).t AS summary,
  CAST(min(page_start) AS INTEGER) AS page_start, CAST(max(page_end) AS INTEGER) AS page_end,
  min((page_start, page_end, ord)).ord AS ord FROM mi GROUP BY doc_id, tk, run)"""
_MERGE = _MERGE.replace("min((page_start, page_end, ord)).ord AS ord", "arg_min(ord, (page_start, page_end, ord)) AS ord")


def _fill(src: str) -> str:
    return f"""pc AS (SELECT doc_id, page_count AS n FROM prof),
fc AS (SELECT s.doc_id, title, section_type, summary, ord,
  CASE WHEN n > 0 THEN least(greatest(page_start, 1), n) ELSE page_start END AS page_start,
  CASE WHEN n > 0 THEN greatest(least(greatest(page_end, 1), n), least(greatest(page_start, 1), n)) ELSE page_end END AS page_end
  FROM {src} s LEFT JOIN pc USING (doc_id)),
pg AS (SELECT doc_id, unnest(range(1, n + 1)) AS p FROM pc WHERE n > 0),
un AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS r FROM pg
  WHERE NOT EXISTS (SELECT 1 FROM fc WHERE fc.doc_id = pg.doc_id AND pg.p BETWEEN fc.page_start AND fc.page_end)),
gp AS (SELECT doc_id, CAST(min(p) AS INTEGER) AS page_start, CAST(max(p) AS INTEGER) AS page_end FROM un GROUP BY doc_id, r),
fl AS (SELECT doc_id, title, section_type, summary, CAST(page_start AS INTEGER) AS page_start, CAST(page_end AS INTEGER) AS page_end, ord FROM fc
  UNION ALL SELECT doc_id, 'Unmapped pages ' || page_start || '-' || page_end, 'unmapped', '{O.UNMAPPED_SUMMARY}', page_start, page_end, NULL FROM gp)"""


RECONCILED = f"""{_MERGE}, {_fill('mg')},
rc AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_start, page_end, ord NULLS LAST, title) - 1 AS INTEGER) AS sec_no FROM fl)"""
_HALVE = """sz AS (SELECT doc_id, page_no, octet_length(encode(text)) AS b FROM pages),
cu AS (SELECT doc_id, page_no, sum(b) OVER (PARTITION BY doc_id ORDER BY page_no) AS c FROM sz),
rg AS ({ranges}),
hv AS (SELECT * FROM (WITH RECURSIVE h AS (
  SELECT doc_id, b0, s, e, {size} AS n FROM rg
  UNION ALL SELECT doc_id, b0, s, e, {size} FROM (
    SELECT h.doc_id, h.b0, CASE WHEN k = 0 THEN h.s ELSE (h.s + h.e) // 2 + 1 END AS s, CASE WHEN k = 0 THEN (h.s + h.e) // 2 ELSE h.e END AS e
    FROM h, (SELECT unnest([0, 1]) AS k) WHERE h.s < h.e AND h.n > {budget}) q)
  SELECT * FROM h WHERE s = e OR n <= {budget}))"""
_SIZE = "((((SELECT c FROM cu WHERE cu.doc_id = {t}.doc_id AND cu.page_no = {t}.e) - coalesce((SELECT c FROM cu WHERE cu.doc_id = {t}.doc_id AND cu.page_no = {t}.s - 1), 0)) + 2) // 3) * 4"


def _halve(ranges: str) -> str:
    h = _HALVE.replace("{ranges}", ranges).replace("{budget}", str(BUDGET))
    a, b, c = h.split("{size}")
    return a + _SIZE.format(t="rg") + b + _SIZE.format(t="q") + c


_PC = "n AS (SELECT doc_id, max(page_no) AS page_count FROM pages GROUP BY doc_id)"
_BATCH4 = "SELECT doc_id, k AS b0, k * 3 + 1 AS s, least(k * 3 + 4, page_count) AS e FROM (SELECT doc_id, page_count, unnest(range(0, CASE WHEN page_count <= 4 THEN 1 ELSE CAST(ceil((page_count - 4) / 3) AS BIGINT) + 1 END)) AS k FROM n)"

QUERIES = {
    f.__name__: f
    for f in (
        page_count, text_layer, plan_batches, slice_pages, slice_to_fit, iter_batches, rebase_pages, first_nonempty,
        dedupe_strings, sanitize_refs, merge_glossary, merge_sections, fill_gaps, reconcile, shared_pages,
    )
}


def _first(c: str, empty: str) -> str:
    v = f"nullif({S.strip(c)}, '')"
    return f"coalesce(arg_min({v}, chunk_index) FILTER (WHERE {v} IS NOT NULL), '{empty}') AS {c}"


_REF = f"nullif({S.strip(S.rep(S.strip('ref'), '^[,;:.' + chr(92) + '-–— ]+'))}, '')"
SQL = {
    "page_count": f"WITH {S.PAGES}, {_PC} SELECT doc_id, page_count FROM n",
    "text_layer": f"WITH {S.PAGES} SELECT * FROM pages",
    "plan_batches": S.BASE + f""", b AS (SELECT doc_id, page_count AS n, unnest(range(0, CASE WHEN page_count <= {MAX_PAGES} THEN 1
        ELSE CAST(ceil((page_count - {MAX_PAGES}) / {MAX_PAGES - OVERLAP}) AS BIGINT) + 1 END)) AS k FROM prof WHERE page_count > 0)
        SELECT doc_id, CAST(k AS INTEGER) AS batch_no, CAST(k * {MAX_PAGES - OVERLAP} + 1 AS INTEGER) AS page_start,
        CAST(least(k * {MAX_PAGES - OVERLAP} + {MAX_PAGES}, n) AS INTEGER) AS page_end FROM b""",
    "slice_pages": S.BASE + f", {S.PAGES}, n AS (SELECT doc_id, max(page_no) AS n FROM pages GROUP BY doc_id), "
    "b AS (SELECT doc_id, n, unnest(range(0, CASE WHEN n <= 4 THEN 1 ELSE (n - 2) // 3 + 1 END)) AS b FROM n) "
    "SELECT p.doc_id, CAST(b AS INTEGER) AS batch_no, p.page_no, p.text FROM b JOIN pages p ON p.doc_id = b.doc_id AND p.page_no BETWEEN b * 3 + 1 AND least(b * 3 + 4, n)",
    "slice_to_fit": f"WITH {S.PAGES}, {_PC}, " + _halve("SELECT doc_id, 0 AS b0, 1 AS s, page_count AS e FROM n")
    + f" SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS slice_no, s AS slice_start, e AS slice_end, n <= {BUDGET} AS fits FROM hv",
    "iter_batches": f"WITH {S.PAGES}, {_PC}, " + _halve(_BATCH4) + f" SELECT doc_id, CAST(b0 AS INTEGER) AS batch_no, s AS slice_start, e AS slice_end, n <= {BUDGET} AS fits FROM hv",
    "rebase_pages": S.BASE + " SELECT section_id, coalesce(page_start, 1) + sec_ord * 2 AS page_start, coalesce(page_end, 1) + sec_ord * 2 AS page_end FROM sec",
    "first_nonempty": S.BASE + f" SELECT source_file, {_first('section_title', '')}, {_first('section_type', 'unknown')}, {_first('section_summary', '')} FROM chk GROUP BY source_file",
    "dedupe_strings": S.BASE + f""", k AS (SELECT source_file, chunk_index, generate_subscripts(keywords, 1) - 1 AS pos, unnest(keywords) AS keyword FROM chk),
        r AS (SELECT *, row_number() OVER (PARTITION BY source_file, {S.dedup_key('keyword')} ORDER BY chunk_index, pos) AS rn FROM k WHERE {S.dedup_key('keyword')} <> '')
        SELECT source_file, {S.strip('keyword')} AS keyword, chunk_index, CAST(pos AS INTEGER) AS pos FROM r WHERE rn = 1""",
    "sanitize_refs": S.BASE + f""", k AS (SELECT doc_id, generate_subscripts(cross_references, 1) - 1 AS pos, unnest(cross_references) AS ref FROM prof),
        c AS (SELECT doc_id, pos, {_REF} AS ref FROM k),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, {S.dedup_key('ref')} ORDER BY pos) AS rn FROM c WHERE ref IS NOT NULL)
        SELECT doc_id, CAST(pos AS INTEGER) AS pos, ref FROM r WHERE rn = 1""",
    "merge_glossary": S.BASE + f""", r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, replace(lower({S.strip('term')}), 'ς', 'σ') ORDER BY term_ord, term_id) AS rn FROM glo WHERE {S.strip('term')} <> '')
        SELECT doc_id, term, definition FROM r WHERE rn = 1""",
    "merge_sections": S.BASE + f", {_MERGE} SELECT * FROM mg",
    "fill_gaps": S.BASE + f", {_REP}, {_fill('rp')} SELECT * EXCLUDE (summary) FROM fl",
    "reconcile": S.BASE + f", {RECONCILED} SELECT * FROM rc",
    "shared_pages": S.BASE + f""", {RECONCILED}, op AS (SELECT doc_id, sec_no, unnest(range(page_start, page_end + 1)) AS p FROM rc),
        oc AS (SELECT *, count(*) OVER (PARTITION BY doc_id, p) AS c FROM op) SELECT doc_id, sec_no, bool_or(c > 1) AS shared FROM oc GROUP BY doc_id, sec_no""",
}
