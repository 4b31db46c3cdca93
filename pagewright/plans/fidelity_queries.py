"""Scores of the given chunks against the text layer of the given documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators import fidelity as Q
from pagewright.operators import grounding as G
from pagewright.operators import outline as O
from pagewright.plans import sqltext as S
from pagewright.plans.base import chunks, doc_pages, profiles, sections
from pagewright.plans.outline_queries import RECONCILED, reconcile
from pagewright.session import table


def _chunks(spark, d):
    """Chunks with the document of their file; a file's chunks may be a third of all, so its one
    profile row meets them through AQE's skew handling."""
    c = chunks(spark, d, "source_file", "chunk_index", "text", "section_title", "page_start", "page_end").where("text is not null")
    return c.join(profiles(spark, d, "source_file").select("doc_id", "source_file"), "source_file")


def _pages(spark, d):
    return doc_pages(spark, d).join(profiles(spark, d).select("doc_id"), "doc_id", "left_semi")


def _out(df, *cols):
    return df.select(*cols, F.col("matched").cast("bigint").alias("matched"), F.col("ref_words").cast("bigint").alias("ref_words"), F.col("cand_words").cast("bigint").alias("cand_words"), "coverage", "novelty")


def score_document(spark, d):
    return _out(Q.score(Q.bag(_pages(spark, d), ["doc_id"]), Q.bag(_chunks(spark, d), ["doc_id"]), ["doc_id"], profiles(spark, d)), "doc_id")


def _section_scores(spark, d):
    return Q.score_sections(reconcile(spark, d), _chunks(spark, d), _pages(spark, d))


def score_sections(spark, d):
    return _out(_section_scores(spark, d), "doc_id", "sec_no")


def fidelity_warnings(spark, d):
    s = O.shared_pages(reconcile(spark, d)).select("doc_id", "sec_no", "section_type", "shared")
    return Q.warnings(_section_scores(spark, d).join(s, ["doc_id", "sec_no"])).select("doc_id", "sec_no", "warn_coverage", "warn_novelty")


def _scored(spark, d):
    un = sections(spark, d, "doc_id", "title", "section_type").where("section_type = 'unmapped'").select("doc_id", F.col("title").alias("section_title")).distinct()
    return Q.scored_chunks(_chunks(spark, d), un)


def novelty_flags(spark, d):
    f = Q.novelty_flags(_scored(spark, d), _pages(spark, d))
    return f.select("chunk_id", "novelty", "n_lines", F.array_join(F.transform("first_lines", lambda x: x.cast("string")), ",").alias("first_lines"))


def _hints(spark, d):
    c, p = _scored(spark, d), _pages(spark, d)
    return Q.locate_lines(Q.line_counts(c, ["doc_id", "chunk_id"]), Q.novel_lines(c, p), p)


def locate_lines(spark, d):
    return _hints(spark, d).select("chunk_id", "line_no", "hint")


def scan_gate(spark, d):
    return Q.scan_gate(doc_pages(spark, d))


def quality_summary(spark, d):
    doc = Q.score(Q.bag(_pages(spark, d), ["doc_id"]), Q.bag(_chunks(spark, d), ["doc_id"]), ["doc_id"], profiles(spark, d))
    return Q.quality_summary(doc, Q.novelty_flags(_scored(spark, d), _pages(spark, d)), _hints(spark, d))


def _line_chunks(spark, d):
    """Every line as a chunk whose declared page is off by -2..2, in a section of its declared page."""
    t = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    page = F.greatest(F.lit(1), (F.floor(F.col("ord") / S.PAGE_LINES) + F.col("ord") % 5 - 1).cast("int"))
    return t.select("doc_id", "ord", "text", page.alias("page_start"), page.alias("page_end"), page.alias("sec_start"), page.alias("sec_end"))


def ground_chunks(spark, d):
    g = G.ground_chunks(_line_chunks(spark, d), doc_pages(spark, d), "doc_id", "ord")
    return g.select("doc_id", "ord", "page_start", "page_end")


def locate_by_words(spark, d):
    return G.locate_by_words(_line_chunks(spark, d), doc_pages(spark, d), "doc_id", "ord")


def _raw_sections(spark, d):
    s = sections(spark, d, "doc_id", "sec_ord", "title", "page_start", "page_end").withColumnRenamed("sec_ord", "ord")
    return O.repair_ranges(s)


def heading_hit(spark, d):
    return G.title_hits(_raw_sections(spark, d), doc_pages(spark, d), "doc_id", "section_id")


def ground_sections(spark, d):
    g = G.ground_sections(_raw_sections(spark, d), doc_pages(spark, d))
    return g.select("section_id", "page_start", "page_end", "grounded")


_CP = S.BASE + f", {S.PAGES}, pp AS (SELECT * FROM pages WHERE doc_id IN (SELECT doc_id FROM prof)), cd AS (SELECT chk.*, prof.doc_id FROM chk JOIN prof USING (source_file) WHERE text IS NOT NULL)"


def _bag(name: str, src: str, keys: str) -> str:
    return f"{name} AS (SELECT {keys}, word, count(*) AS n FROM (SELECT {keys}, unnest({S.words('text')}) AS word FROM {src}) GROUP BY ALL)"


def _score(name: str, ref: str, cand: str, keys: str, every: str) -> str:
    on = ", ".join(keys.split(", "))
    return f"""{name}0 AS (SELECT {on}, word, coalesce(r.n, 0) AS r, coalesce(c.n, 0) AS c FROM {ref} r FULL JOIN {cand} c USING ({on}, word)),
{name}1 AS (SELECT {on}, sum(least(r, c)) AS m, sum(r) AS r, sum(c) AS c FROM {name}0 GROUP BY ALL),
{name} AS (SELECT {on}, CAST(coalesce(m, 0) AS BIGINT) AS matched, CAST(coalesce(r, 0) AS BIGINT) AS ref_words, CAST(coalesce(c, 0) AS BIGINT) AS cand_words,
  CASE WHEN coalesce(r, 0) = 0 THEN 1.0::DOUBLE ELSE m / r END AS coverage, CASE WHEN coalesce(c, 0) = 0 THEN 0.0::DOUBLE ELSE 1 - m / c END AS novelty
  FROM {every} LEFT JOIN {name}1 USING ({on}))"""


def _ranges(name: str, src: str, ident: str) -> str:
    return f"""{name}l AS (SELECT doc_id, max(page_no) AS n FROM pp GROUP BY doc_id),
{name}o AS (SELECT doc_id, {ident}, greatest(1, least(page_start, n)) AS s, greatest(greatest(1, least(page_start, n)), least(page_end, n)) AS e FROM {src} JOIN {name}l USING (doc_id)),
{name}r AS (SELECT o.doc_id, {ident}, word, sum(b.n) AS n FROM {name}o o JOIN pb b ON b.doc_id = o.doc_id AND b.page_no BETWEEN s AND e GROUP BY ALL)"""


_DOC = f"{_bag('rb', 'pp', 'doc_id')}, {_bag('cb', 'cd', 'doc_id')}, {_score('ds', 'rb', 'cb', 'doc_id', '(SELECT doc_id FROM prof)')}"
_SEC = f"""{RECONCILED}, {_bag('pb', 'pp', 'doc_id, page_no')}, {_ranges('sr', 'rc', 'sec_no')}, {_bag('tb', 'cd', 'doc_id, section_title')},
sc AS (SELECT rc.doc_id, sec_no, word, tb.n FROM rc JOIN tb ON tb.doc_id = rc.doc_id AND tb.section_title = rc.title),
{_score('ss', 'srr', 'sc', 'doc_id, sec_no', '(SELECT doc_id, sec_no FROM rc)')}"""
_LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_FLAGS = f"""um AS (SELECT DISTINCT doc_id, title AS section_title FROM sec WHERE section_type = 'unmapped'),
sd AS (SELECT * FROM cd WHERE {S.space_words('text')} >= 20 AND page_start IS NOT NULL AND page_end IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM um WHERE um.doc_id = cd.doc_id AND um.section_title = cd.section_title)),
{_bag('pb', 'pp', 'doc_id, page_no')}, {_ranges('cr', 'sd', 'chunk_id')}, {_bag('kb', 'sd', 'doc_id, chunk_id')},
{_score('cs', 'crr', 'kb', 'doc_id, chunk_id', '(SELECT DISTINCT doc_id, chunk_id FROM sd)')},
la AS (SELECT doc_id, chunk_id, regexp_split_to_array(text, '{_LINE_END}') AS a FROM sd),
lb AS (SELECT doc_id, chunk_id, generate_subscripts(a, 1) - 1 AS line_no, unnest(a) AS line FROM la),
lc AS (SELECT doc_id, chunk_id, line_no, {S.words('line')} AS w FROM lb),
ld AS (SELECT doc_id, chunk_id, line_no, len(w) AS total, unnest(w) AS word FROM lc WHERE len(w) >= 4),
le AS (SELECT ld.doc_id, ld.chunk_id, line_no, total, sum(CASE WHEN crr.word IS NULL THEN 1 ELSE 0 END) AS absent FROM ld LEFT JOIN crr ON crr.chunk_id = ld.chunk_id AND crr.word = ld.word GROUP BY ALL),
nl AS (SELECT * FROM le WHERE absent / total >= 0.5),
nn AS (SELECT chunk_id, count(*) AS n_lines, array_to_string(list_sort(list(line_no))[1:3], ',') AS first_lines, list_sort(list(line_no))[1:3] AS fl FROM nl GROUP BY chunk_id),
fg AS (SELECT cs.doc_id, cs.chunk_id, novelty, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, coalesce(first_lines, '') AS first_lines, fl FROM cs LEFT JOIN nn USING (chunk_id)
  WHERE doc_id IN (SELECT doc_id FROM pp) AND (novelty > 0.15 OR n_lines > 0))"""
_LOC = """lo AS (SELECT l.doc_id, l.chunk_id, l.line_no, p.page_no, l.total, count(*) AS there FROM ld l JOIN nl USING (doc_id, chunk_id, line_no) JOIN pb p ON p.doc_id = l.doc_id AND p.word = l.word GROUP BY ALL),
lh AS (SELECT chunk_id, line_no, list_sort(list(page_no)) AS p FROM lo WHERE (total - there) / total < 0.5 GROUP BY ALL),
ht AS (SELECT nl.doc_id, nl.chunk_id, CAST(nl.line_no AS INTEGER) AS line_no, CASE WHEN p IS NULL THEN 'not in the text layer of any page (invented, or the text layer is incomplete there)'
  ELSE 'found on page ' || array_to_string(p[1:3], ', ') || CASE WHEN len(p) > 3 THEN '+' ELSE '' END || ' (misattributed pages)' END AS hint FROM nl LEFT JOIN lh USING (chunk_id, line_no))"""
_LC = f"""WITH {S.PAGES}, lca AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
lcb AS (SELECT doc_id, generate_subscripts(a, 1) - 1 AS ord, unnest(a) AS text FROM lca),
lk AS (SELECT doc_id, ord, text, CAST(greatest(1, ord // {S.PAGE_LINES} + ord % 5 - 1) AS INTEGER) AS pg FROM lcb),
ln AS (SELECT doc_id, max(page_no) AS n FROM pages GROUP BY doc_id),
lw AS (SELECT lk.*, {S.match_key('text')} AS k, greatest(pg, 1) AS lo, least(pg, n) AS hi, greatest(pg - 3, 1) AS wlo, least(pg + 3, n) AS whi FROM lk JOIN ln USING (doc_id)),
pw AS (SELECT DISTINCT doc_id, page_no, unnest({S.words('text', 4)}) AS word FROM pages),
rw AS (SELECT doc_id, word FROM pw GROUP BY doc_id, word HAVING count(*) <= 3),
cw AS (SELECT DISTINCT doc_id, ord, wlo, whi, unnest({S.words('text', 4)}) AS word FROM lw WHERE wlo <= whi),
cr AS (SELECT cw.* FROM cw JOIN rw USING (doc_id, word)),
cn AS (SELECT doc_id, ord, count(*) AS n FROM cr GROUP BY ALL HAVING count(*) >= 5),
cp AS (SELECT cr.doc_id, cr.ord, wlo, whi, page_no, count(*) AS sc FROM cr JOIN cn USING (doc_id, ord) JOIN pw ON pw.doc_id = cr.doc_id AND pw.word = cr.word AND page_no BETWEEN wlo AND whi GROUP BY ALL),
cb AS (SELECT doc_id, ord, arg_min(page_no, (-sc, page_no)) AS p, max(sc) AS b FROM cp GROUP BY ALL),
cf AS (SELECT *, greatest(1, CAST(floor(b * 0.25) AS INTEGER)) AS f FROM cb),
cx AS (SELECT cf.*, bool_or(cp.page_no = p - 1 AND sc >= f) AS l1, bool_or(cp.page_no = p - 2 AND sc >= f) AS l2, bool_or(cp.page_no = p + 1 AND sc >= f) AS r1, bool_or(cp.page_no = p + 2 AND sc >= f) AS r2
  FROM cf JOIN cp ON cp.doc_id = cf.doc_id AND cp.ord = cf.ord GROUP BY ALL),
cl AS (SELECT *, CASE WHEN l1 AND l2 THEN 2 WHEN l1 THEN 1 ELSE 0 END AS l FROM cx),
cz AS (SELECT doc_id, ord, p - l AS a, p + CASE WHEN 2 - l >= 2 AND r1 AND r2 THEN 2 WHEN 2 - l >= 1 AND r1 THEN 1 ELSE 0 END AS z FROM cl),
cc AS (SELECT cz.doc_id, cz.ord, a, z, count(DISTINCT pw.word) AS cov FROM cz JOIN cr ON cr.doc_id = cz.doc_id AND cr.ord = cz.ord JOIN pw ON pw.doc_id = cr.doc_id AND pw.word = cr.word AND pw.page_no BETWEEN a AND z GROUP BY ALL),
cy AS (SELECT cc.doc_id, cc.ord, a AS span_start, z AS span_end FROM cc JOIN cn USING (doc_id, ord) WHERE cov / n >= 0.5)"""
_GC = _LC + f""", pk AS (SELECT doc_id, page_no, {S.match_key('text')} AS pk FROM pages),
ge AS (SELECT lw.doc_id, lw.ord, count(*) FILTER (WHERE contains(pk, k[1:40]) AND page_no BETWEEN lo AND hi) AS an, count(*) FILTER (WHERE contains(pk, k[1:40])) AS aw,
  min(page_no) FILTER (WHERE contains(pk, k[1:40]) AND page_no BETWEEN lo AND hi) AS apn, min(page_no) FILTER (WHERE contains(pk, k[1:40])) AS apw,
  count(*) FILTER (WHERE contains(pk, right(k, 40)) AND page_no BETWEEN lo AND hi) AS zn, count(*) FILTER (WHERE contains(pk, right(k, 40))) AS zw,
  min(page_no) FILTER (WHERE contains(pk, right(k, 40)) AND page_no BETWEEN lo AND hi) AS zpn, min(page_no) FILTER (WHERE contains(pk, right(k, 40))) AS zpw
  FROM lw JOIN pk ON pk.doc_id = lw.doc_id AND page_no BETWEEN wlo AND whi WHERE length(k) >= 15 GROUP BY ALL),
gp AS (SELECT lw.doc_id, lw.ord, pg, length(k) >= 15 AS ok, CASE WHEN an = 1 THEN apn WHEN an = 0 AND aw = 1 THEN apw END AS ps, CASE WHEN zn = 1 THEN zpn WHEN zn = 0 AND zw = 1 THEN zpw END AS pe FROM lw LEFT JOIN ge USING (doc_id, ord)),
gq AS (SELECT gp.doc_id, gp.ord, pg, CASE WHEN ok AND ps IS NULL AND pe IS NULL THEN span_start ELSE ps END AS ps, CASE WHEN ok AND ps IS NULL AND pe IS NULL THEN span_end ELSE pe END AS pe FROM gp LEFT JOIN cy USING (doc_id, ord)),
gr AS (SELECT *, coalesce(ps > pe, false) AS bad, coalesce(ps, pg) AS s, coalesce(pe, pg) AS e FROM gq)
SELECT doc_id, CAST(ord AS INTEGER) AS ord, CASE WHEN bad THEN pg WHEN s > e AND ps IS NULL THEN pe ELSE s END AS page_start, CASE WHEN bad THEN pg WHEN s > e AND ps IS NOT NULL THEN ps ELSE e END AS page_end FROM gr"""
_HIT = f"""{S.PAGES}, rs AS (SELECT section_id, doc_id, sec_ord AS ord, title, coalesce(page_start, page_end, 1) AS page_start,
  greatest(coalesce(page_end, page_start, 1), coalesce(page_start, page_end, 1)) AS page_end, {S.match_key('title')} AS k FROM sec),
pk AS (SELECT doc_id, page_no, {S.match_key('text')} AS pk FROM pages),
hj AS (SELECT rs.doc_id, section_id, page_no, strpos(replace(pk, 'section' || k, 'section' || repeat('~', length(k))), k) - 1 AS off FROM rs JOIN pk ON pk.doc_id = rs.doc_id WHERE length(k) >= 6 AND contains(pk, k)),
hits AS (SELECT doc_id, section_id, page_no, CAST(off AS INTEGER) AS off FROM hj WHERE off >= 0)"""
_GS = f"""{_HIT}, ix AS (SELECT doc_id, page_no FROM hits GROUP BY ALL HAVING count(*) >= 3),
rl AS (SELECT * FROM hits WHERE NOT EXISTS (SELECT 1 FROM ix WHERE ix.doc_id = hits.doc_id AND ix.page_no = hits.page_no)),
g1 AS (SELECT section_id, min(page_no) AS p, min(off) AS off FROM rl GROUP BY section_id HAVING count(*) = 1),
pw AS (SELECT DISTINCT doc_id, page_no, unnest({S.words('text', 3)}) AS word FROM pages),
rr AS (SELECT doc_id, word FROM pw GROUP BY ALL HAVING count(*) <= 4),
tw AS (SELECT DISTINCT doc_id, section_id, unnest({S.words('title', 3)}) AS word FROM rs WHERE length(k) >= 6 AND section_id NOT IN (SELECT section_id FROM g1)),
tr AS (SELECT tw.* FROM tw JOIN rr USING (doc_id, word)),
tn AS (SELECT section_id, count(*) AS n FROM tr GROUP BY section_id HAVING count(*) >= 2),
tp AS (SELECT tr.doc_id, tr.section_id, page_no, count(*) AS m FROM tr JOIN pw USING (doc_id, word) GROUP BY ALL),
g2 AS (SELECT section_id, min(page_no) AS p, 0 AS off FROM tp JOIN tn USING (section_id) WHERE m = n AND NOT EXISTS (SELECT 1 FROM ix WHERE ix.doc_id = tp.doc_id AND ix.page_no = tp.page_no) GROUP BY section_id HAVING count(*) = 1),
gg AS (SELECT * FROM g1 UNION ALL SELECT * FROM g2),
s1 AS (SELECT rs.section_id, doc_id, ord, gg.p IS NOT NULL AS grounded, off, coalesce(gg.p, page_start) AS page_start, greatest(coalesce(gg.p, page_start), page_end) AS page_end FROM rs LEFT JOIN gg USING (section_id)),
s2 AS (SELECT *, lead(grounded) OVER w AS ng, greatest(lead(page_start) OVER w - CASE WHEN lead(off) OVER w <= 120 THEN 1 ELSE 0 END, page_start) AS b FROM s1 WINDOW w AS (PARTITION BY doc_id ORDER BY page_start, page_end, ord, section_id))
SELECT section_id, page_start, CASE WHEN ng IS NULL OR NOT ng THEN page_end WHEN grounded THEN b ELSE least(page_end, b) END AS page_end, grounded FROM s2"""

QUERIES = {
    f.__name__: f
    for f in (
        score_document, score_sections, fidelity_warnings, novelty_flags, locate_lines, scan_gate, quality_summary,
        ground_chunks, locate_by_words, heading_hit, ground_sections,
    )
}
SQL = {
    "score_document": f"{_CP}, {_DOC} SELECT * FROM ds",
    "score_sections": f"{_CP}, {_SEC} SELECT * FROM ss",
    "fidelity_warnings": f"""{_CP}, {_SEC}, op AS (SELECT doc_id, sec_no, unnest(range(page_start, page_end + 1)) AS p FROM rc),
        oc AS (SELECT *, count(*) OVER (PARTITION BY doc_id, p) AS c FROM op), sh AS (SELECT doc_id, sec_no, bool_or(c > 1) AS shared FROM oc GROUP BY doc_id, sec_no)
        SELECT doc_id, sec_no, NOT shared AND coalesce(section_type, '') <> 'unmapped' AND coverage < 0.85 AS warn_coverage, NOT shared AND novelty > 0.15 AS warn_novelty
        FROM ss JOIN sh USING (doc_id, sec_no) JOIN rc USING (doc_id, sec_no)""",
    "novelty_flags": f"{_CP}, {_FLAGS} SELECT chunk_id, novelty, n_lines, first_lines FROM fg",
    "locate_lines": f"{_CP}, {_FLAGS}, {_LOC} SELECT chunk_id, line_no, hint FROM ht",
    "scan_gate": f"WITH {S.PAGES}, s AS (SELECT doc_id, sum(length({S.strip('text')})) AS layer_chars FROM pages GROUP BY doc_id) SELECT doc_id, CAST(layer_chars AS BIGINT) AS layer_chars, CASE WHEN layer_chars < 200 THEN 'skipped' ELSE 'ok' END AS status FROM s",
    "quality_summary": f"""{_CP}, {_DOC}, {_FLAGS}, {_LOC}, f AS (SELECT doc_id, count(*) AS n FROM fg GROUP BY doc_id), u AS (SELECT doc_id, chunk_id, unnest(fl) AS line_no FROM fg),
        h AS (SELECT u.doc_id, count(*) FILTER (WHERE hint LIKE '%misattributed%') AS a, count(*) FILTER (WHERE hint LIKE '%not in the text layer%') AS b FROM u JOIN ht USING (chunk_id, line_no) GROUP BY u.doc_id)
        SELECT doc_id, coverage >= 0.85 AS coverage_ok, novelty <= 0.15 AS novelty_ok, coalesce(n, 0) AS flagged_chunks, coalesce(a, 0) AS flags_misattributed, coalesce(b, 0) AS flags_not_in_layer
        FROM ds LEFT JOIN f USING (doc_id) LEFT JOIN h USING (doc_id)""",
    "ground_chunks": _GC,
    "locate_by_words": _LC + " SELECT doc_id, CAST(ord AS INTEGER) AS ord, span_start, span_end FROM cy",
    "heading_hit": S.BASE + f", {_HIT} SELECT doc_id, section_id, page_no, off AS \"offset\" FROM hits",
    "ground_sections": S.BASE + f", {_GS}",
}
