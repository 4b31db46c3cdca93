"""Chunk operators over the given chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators import chunks as C
from pagewright.plans import sqltext as S
from pagewright.plans.base import chunks, sections
from pagewright.session import spread, table

LIMIT, WORD_LIMIT, TARGET = 256, 64, 512


def _raw(spark, d):
    """Raw chunks: sec is the section title, in its file."""
    c = chunks(spark, d, "source_file", "chunk_index", "text", "section_title", "section_type", "keywords", "cross_references", "page_start", "page_end")
    return c.where("text is not null and source_file is not null").withColumn("sec", F.coalesce("section_title", F.lit("")))


def clean_chunks(spark, d):
    return C.clean_raw_chunks(_raw(spark, d)).select("chunk_id", "text")


def dedupe_chunks(spark, d):
    return C.dedupe_raw_chunks(_raw(spark, d), ["source_file", "sec"], "chunk_index").select("source_file", "chunk_index", "text")


def enforce_limit(spark, d):
    p = C.enforce_token_limit(_raw(spark, d).select("chunk_id", "text"), LIMIT)
    return p.select("chunk_id", F.posexplode_outer("pieces").alias("pos", "piece"))


def split_long_sentence(spark, d):
    s = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.posexplode_outer(T.sentences(F.col("text"))).alias("pos", "sentence")).where("pos is not null")
    p = C.split_long_sentence(s, "sentence", WORD_LIMIT)
    return p.select("doc_id", "pos", F.posexplode_outer("pieces").alias("part", "piece")).where("part is not null")


def pack_pieces(spark, d):
    p = C.pack_chunks(_raw(spark, d), ["source_file", "sec"], "chunk_index", TARGET)
    return p.select(
        "source_file", "sec", "grp", "text", F.array_join("keywords", "|").alias("keywords"), F.array_join("cross_references", "|").alias("cross_references"),
        "page_start", "page_end", "n_pieces",
    )


def normalize_pages(spark, d):
    """Pages of the chunks within the page range of their file's section of the same title."""
    s = sections(spark, d, "doc_id", "title", "page_start", "page_end").where("page_start <= page_end")
    p = table(spark, d, "profiles").select("doc_id", "source_file").distinct()
    s = s.join(p, "doc_id").groupBy("source_file", F.col("title").alias("section_title")).agg(F.min("page_start").alias("ss"), F.max("page_end").alias("se"))
    c = chunks(spark, d, "source_file", "section_title", "page_start", "page_end").join(s, ["source_file", "section_title"])
    return C.normalize_chunk_pages(c.withColumn("off", F.lit(1)), "off", "ss", "se").select("chunk_id", "page_start", "page_end")


def assemble_chunks(spark, d):
    """The flagship: cleaned, deduplicated, guarded, packed and numbered chunks with content ids."""
    raw = C.dedupe_raw_chunks(C.clean_raw_chunks(_raw(spark, d)), ["source_file", "sec"], "chunk_index")
    a = C.assemble_chunks(raw, "source_file", "sec", "chunk_index", LIMIT, TARGET)
    ident = T.content_id("chk_", F.concat(F.col("source_file"), F.lit("::"), F.col("text")))
    return a.select("source_file", "sec", "chunk_index", ident.alias("id"), "token_count", "page_start", "page_end", "n_pieces")


def pack_chunks(spark, d):
    """Documents as lines, packed to the target: every document's chunks with their ids."""
    t = spread(table(spark, d, "documents").where("text is not null").select("doc_id", "text")).select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("ord", "text"))
    t = t.where("text <> ''").withColumns({"keywords": F.array().cast("array<string>"), "cross_references": F.array().cast("array<string>"), "page_start": (F.floor(F.col("ord") / 3) + 1).cast("int"), "page_end": (F.floor(F.col("ord") / 3) + 1).cast("int")})
    p = C.pack_chunks(t, ["doc_id"], "ord", 128)
    return p.select("doc_id", F.col("grp").alias("chunk_index"), T.content_id("chk_", F.col("text")).alias("id"), T.token_count(F.col("text")).alias("token_count"), "page_start", "page_end", "n_pieces")


_RAW = S.BASE + ", raw AS (SELECT *, coalesce(section_title, '') AS sec FROM chk WHERE text IS NOT NULL AND source_file IS NOT NULL)"
_CLEAN = f"SELECT chunk_id, source_file, chunk_index, sec, {S.leaders('text')} AS text, keywords, cross_references, page_start, page_end FROM raw WHERE NOT (coalesce(section_type = 'unmapped', false) AND {S.is_toc('text')})"


def _dedupe(src: str) -> str:
    return f"""d1 AS (SELECT *, row_number() OVER (PARTITION BY source_file, sec, {S.dedup_key('text')} ORDER BY chunk_index) AS rn FROM {src} WHERE {S.dedup_key('text')} <> ''),
d2 AS (SELECT source_file, sec, chunk_index, text, regexp_split_to_array(text, '\\n\\s*\\n') AS a FROM d1 WHERE rn = 1),
d3 AS (SELECT source_file, sec, chunk_index, unnest(a) AS para, generate_subscripts(a, 1) AS pos FROM d2),
d4 AS (SELECT *, {S.dedup_key('para')} AS k, {S.space_words('para')} >= 25 AS long FROM d3),
d5 AS (SELECT *, long AND row_number() OVER (PARTITION BY source_file, sec, k, long ORDER BY chunk_index, pos) > 1 AS again FROM d4),
d6 AS (SELECT source_file, sec, chunk_index, bool_or(again) AS lost, string_agg(para, chr(10) || chr(10) ORDER BY pos) FILTER (WHERE NOT again) AS rest FROM d5 GROUP BY ALL),
dd AS (SELECT d2.source_file, d2.sec, d2.chunk_index, CASE WHEN lost THEN coalesce(rest, '') ELSE text END AS text FROM d2 JOIN d6 USING (source_file, sec, chunk_index))"""


def _fold(name: str, atoms: str, keys: str, limit: int) -> str:
    """Recursive greedy fold over (keys, i, u, g) rows of `atoms`, i from 0: adds piece."""
    on = " AND ".join(f"a.{k} = f.{k}" for k in keys.split(", "))
    return f"""{name} AS (SELECT * FROM (WITH RECURSIVE f AS (
  SELECT {keys}, i, u AS acc, g, 0 AS piece FROM {atoms} WHERE i = 0
  UNION ALL SELECT {', '.join('f.' + k for k in keys.split(', '))}, a.i,
    CASE WHEN a.g <> f.g OR floor((f.acc + a.u) * 1.3) + 1 > {limit} THEN a.u ELSE f.acc + a.u END, a.g,
    CASE WHEN a.g <> f.g OR floor((f.acc + a.u) * 1.3) + 1 > {limit} THEN f.piece + 1 ELSE f.piece END
  FROM f JOIN {atoms} a ON {on} AND a.i = f.i + 1) SELECT * FROM f))"""


def _enforce(src: str, key: str, limit: int) -> str:
    """(key, pos, piece) of the texts of `src`."""
    k = key.split(", ")
    ck = ", ".join(k)
    sent = f"list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda x: {S.strip('x')}), lambda x: x <> '')"
    return f"""e1 AS (SELECT {ck}, text, {sent} AS ss FROM {src} WHERE {S.tokens('text')} > {limit}),
e2 AS (SELECT {ck}, unnest(ss) AS s, generate_subscripts(ss, 1) AS si FROM e1),
e3 AS (SELECT {ck}, si, CASE WHEN {S.tokens('s')} > {limit} THEN regexp_extract_all(s, '{S.NON_SPACE}+') ELSE [s] END AS ws, CASE WHEN {S.tokens('s')} > {limit} THEN si ELSE -1 END AS g FROM e2),
e4 AS (SELECT {ck}, si, g, unnest(ws) AS t, generate_subscripts(ws, 1) AS wi FROM e3),
e5 AS MATERIALIZED (SELECT {ck}, g, t, {S.units('t')} AS u, row_number() OVER (PARTITION BY {ck} ORDER BY si, wi) - 1 AS i FROM e4),
{_fold('e6', 'e5', ck, limit)},
e7 AS (SELECT {ck}, e6.piece AS pos, string_agg(t, ' ' ORDER BY i) AS piece FROM e6 JOIN e5 USING ({ck}, i) GROUP BY {ck}, e6.piece),
en AS (SELECT {ck}, pos, piece FROM e7 UNION ALL SELECT {ck}, 0, text FROM {src} s WHERE NOT EXISTS (SELECT 1 FROM e7 WHERE {' AND '.join(f'e7.{x} = s.{x}' for x in k)}))"""


def _pack(src: str, keys: str, order: str, target: int) -> str:
    return f"""q1 AS MATERIALIZED (SELECT *, {S.units('text')} AS u, 0 AS g, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) - 1 AS i FROM {src}),
{_fold('q2', 'q1', keys, target)},
pk AS (SELECT {keys}, CAST(q2.piece AS INTEGER) AS grp, string_agg(text, chr(10) || chr(10) ORDER BY i) AS text, min(nullif(page_start, 0)) AS page_start,
  max(nullif(page_end, 0)) AS page_end, count(*) AS n_pieces FROM q2 JOIN q1 USING ({keys}, i) GROUP BY {keys}, q2.piece)"""


_KW = """{n}0 AS (SELECT source_file, sec, CAST(q2.piece AS INTEGER) AS grp, i, unnest({c}) AS v, generate_subscripts({c}, 1) AS o FROM q2 JOIN q1 USING (source_file, sec, i)),
{n}1 AS (SELECT source_file, sec, grp, v, min((i * 100000 + o)) AS o FROM {n}0 GROUP BY ALL),
{n}2 AS (SELECT source_file, sec, grp, string_agg(v, '|' ORDER BY o) AS {c} FROM {n}1 GROUP BY ALL)"""

QUERIES = {
    f.__name__: f
    for f in (clean_chunks, dedupe_chunks, enforce_limit, split_long_sentence, pack_pieces, normalize_pages, assemble_chunks, pack_chunks)
}
SQL = {
    "clean_chunks": _RAW + f" SELECT chunk_id, text FROM ({_CLEAN})",
    "dedupe_chunks": _RAW + f", {_dedupe('raw')} SELECT source_file, chunk_index, text FROM dd WHERE {S.strip('text')} <> ''",
    "enforce_limit": _RAW + f", {_enforce('raw', 'chunk_id', LIMIT)} SELECT chunk_id, CAST(pos AS INTEGER) AS pos, piece FROM en",
    "split_long_sentence": f"""WITH s0 AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda x: {S.strip('x')}), lambda x: x <> '') AS a FROM documents),
        s1 AS (SELECT doc_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS s FROM s0),
        s2 AS (SELECT doc_id, pos, unnest(regexp_extract_all(s, '{S.NON_SPACE}+')) AS t, generate_subscripts(regexp_extract_all(s, '{S.NON_SPACE}+'), 1) - 1 AS i FROM s1),
        s3 AS MATERIALIZED (SELECT doc_id, pos, t, i, 0 AS g, {S.units('t')} AS u FROM s2), {_fold('s4', 's3', 'doc_id, pos', WORD_LIMIT)}
        SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(s4.piece AS INTEGER) AS part, string_agg(t, ' ' ORDER BY i) AS piece FROM s4 JOIN s3 USING (doc_id, pos, i) GROUP BY doc_id, pos, s4.piece""",
    "pack_pieces": _RAW + f", {_pack('raw', 'source_file, sec', 'chunk_index', TARGET)}, " + _KW.format(n="kw", c="keywords") + ", " + _KW.format(n="xr", c="cross_references")
    + " SELECT pk.*, coalesce(keywords, '') AS keywords, coalesce(cross_references, '') AS cross_references FROM pk LEFT JOIN kw2 USING (source_file, sec, grp) LEFT JOIN xr2 USING (source_file, sec, grp)",
    "normalize_pages": S.BASE + """, p AS (SELECT DISTINCT doc_id, source_file FROM profiles),
        s AS (SELECT source_file, title AS section_title, min(page_start) AS ss, max(page_end) AS se FROM sec JOIN p USING (doc_id) WHERE page_start <= page_end GROUP BY ALL),
        c AS (SELECT chunk_id, page_start + 1 AS a, page_end + 1 AS b, ss, se FROM chk JOIN s USING (source_file, section_title)),
        g AS (SELECT *, coalesce(a BETWEEN ss AND se AND b >= a, false) AS good FROM c)
        SELECT chunk_id, CASE WHEN good THEN a ELSE ss END AS page_start, CASE WHEN good THEN least(b, se) ELSE se END AS page_end FROM g""",
    "assemble_chunks": _RAW + f", cl AS ({_CLEAN}), {_dedupe('cl')}, dr AS (SELECT * FROM dd WHERE {S.strip('text')} <> ''), {_enforce('dr', 'source_file, sec, chunk_index', LIMIT)}, "
    + "ep AS (SELECT en.source_file, en.sec, en.chunk_index, en.pos, en.piece AS text, page_start, page_end FROM en JOIN cl USING (source_file, sec, chunk_index)), "
    + _pack("ep", "source_file, sec", "chunk_index, pos", 256) + f""" SELECT source_file, sec, CAST(row_number() OVER (PARTITION BY source_file ORDER BY sec, grp) - 1 AS INTEGER) AS chunk_index,
        {S.content_id('chk_', "(source_file || '::' || text)")} AS id, {S.tokens('text')} AS token_count, page_start, page_end, n_pieces FROM pk""",
    "pack_chunks": "WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL), m AS (SELECT doc_id, unnest(a) AS text, generate_subscripts(a, 1) - 1 AS ord FROM l), "
    + "r AS (SELECT *, CAST(ord // 3 + 1 AS INTEGER) AS page_start, CAST(ord // 3 + 1 AS INTEGER) AS page_end FROM m WHERE text <> ''), " + _pack("r", "doc_id", "ord", 128)
    + f" SELECT doc_id, grp AS chunk_index, {S.content_id('chk_', 'text')} AS id, {S.tokens('text')} AS token_count, page_start, page_end, n_pieces FROM pk",
}
