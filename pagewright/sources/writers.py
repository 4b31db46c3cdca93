"""Sinks: JSON lines, profiles, typed Parquet tables, managed tables, a review page."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.schemas import EXPORT_CHUNKS, EXPORT_DOCUMENTS, EXPORT_GLOSSARY

#: Most chunks that a review page of one document holds.
PAGE_CHUNKS = 20_000


def write_chunks(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, null fields included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_profiles(df: DataFrame, path: str, fidelity: DataFrame | None = None, key: str = "source_file") -> None:
    """One indented JSON document per profile, with its fidelity block if given."""
    if fidelity is not None:
        cols = [c for c in fidelity.columns if c != key]
        df = df.join(fidelity.select(key, F.struct(*cols).alias("fidelity")), key, "left")
    df.select(F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("value")).write.mode("overwrite").text(path, lineSep="\n\n")


def write_export(path: str, chunks: DataFrame, documents: DataFrame, glossary: DataFrame | None = None) -> list[str]:
    """The typed tables under `path`; a glossary without rows isn't written."""
    done = []
    for name, df, schema in (("chunks", chunks, EXPORT_CHUNKS), ("documents", documents, EXPORT_DOCUMENTS), ("glossary", glossary, EXPORT_GLOSSARY)):
        if df is None or (name == "glossary" and df.isEmpty()):
            continue
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("overwrite").parquet(f"{path}/{name}")
        done.append(name)
    return done


def save_table(df: DataFrame, name: str) -> None:
    """First load of a managed table: data and schema are replaced."""
    df.write.mode("overwrite").option("overwriteSchema", True).saveAsTable(name)


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def embed_json(value: object) -> str:
    """JSON that is safe inside a script element (the two replacements are fixed values)."""
    return json.dumps(value, ensure_ascii=False).replace("</", "<\\/").replace("<!--", "<\\!--")


_PAGE = """<!doctype html><meta charset="utf-8"><title>Chunks</title>
<style>body{font:14px sans-serif;margin:2em;max-width:60em}.c{border:1px solid #ccc;padding:.6em;margin:.6em 0;white-space:pre-wrap}small{color:#666}</style>
<input id="q" placeholder="filter" autofocus><span id="n"></span><div id="l"></div>
<script>const D=__DATA__;const l=document.getElementById('l'),q=document.getElementById('q');
function show(){l.textContent='';const s=q.value.toLowerCase();let n=0;for(const c of D.chunks){
const h=[c.text,(c.keywords||[]).join(' '),c.section_title].join(' ').toLowerCase();if(!h.includes(s))continue;n++;
const e=document.createElement('div');e.className='c';const m=document.createElement('small');
m.textContent='#'+c.chunk_index+' '+(c.section_title||'')+' p.'+c.page_start+'-'+c.page_end+' '+c.token_count+' tokens\\n';
e.append(m,c.text);l.append(e)}document.getElementById('n').textContent=' '+n+' of '+D.chunks.length}
q.oninput=show;show()</script>"""


def review_page(profile: dict, chunks: DataFrame) -> str:
    """A self-contained page of one document's chunks; more than PAGE_CHUNKS are an error."""
    rows = chunks.orderBy("chunk_index").limit(PAGE_CHUNKS + 1).collect()
    if len(rows) > PAGE_CHUNKS:
        raise ValueError(f"the document has more than {PAGE_CHUNKS} chunks")
    return _PAGE.replace("__DATA__", embed_json({"profile": profile, "chunks": [r.asDict(recursive=True) for r in rows]}))
