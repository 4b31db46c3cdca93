"""Command line: chunk, analyze, fidelity, view, serve and export."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from pagewright.config import EngineConfig
from pagewright.operators import fidelity as Q
from pagewright.operators.curate import usage_totals
from pagewright.operators.model_call import COUNTERS, usage_summary
from pagewright.plans import pipeline
from pagewright.session import build_session, materialize, release
from pagewright.sources import readers, writers


def _pages(spark, path: str, plain: bool):
    p = readers.page_texts(readers.read_documents(spark, path), readers.text_pages if plain else readers.pdf_pages)
    return p.withColumnRenamed("source_file", "doc_id")


def named(df):
    return df.withColumnRenamed("doc_id", "source_file")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pagewright")
    sub = p.add_subparsers(dest="command", required=True)
    for name, text in (("chunk", "documents to chunk lines"), ("analyze", "documents to profiles"), ("fidelity", "scores of existing chunks")):
        s = sub.add_parser(name, help=text)
        s.add_argument("documents")
        s.add_argument("--out", required=True)
        s.add_argument("--plain", action="store_true", help="plain text files, pages separated by form feeds")
        s.add_argument("--max-tokens", type=int, default=1024)
        s.add_argument("--target-tokens", type=int, default=512)
        s.add_argument("--tokenizer", help="vocabulary file for exact counts")
        s.add_argument("--batch-pages", type=int, default=50)
        s.add_argument("--batch-overlap", type=int, default=1)
        s.add_argument("--max-request-mb", type=float, default=25.0)
        s.add_argument("--outline-concurrency", type=int)
        s.add_argument("--chunk-concurrency", type=int)
        if name == "fidelity":
            s.add_argument("--chunks", required=True)
            s.add_argument("--profiles", help="document maps, for scores of sections and flags of chunks")
        if name == "chunk":
            s.add_argument("--profiles", help="folder of the document maps; OUT/profiles by default")
            s.add_argument("--resume", action="store_true", help="go on with the maps and chunks of an interrupted run")
            s.add_argument("--no-fidelity", action="store_true")
    s = sub.add_parser("view", help="a review page of one document's chunks")
    s.add_argument("chunks")
    s.add_argument("--source-file")
    s.add_argument("--out", required=True)
    s = sub.add_parser("serve", help="chunk the documents that arrive in a folder")
    s.add_argument("folder")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--once", action="store_true")
    s.add_argument("--plain", action="store_true")
    s = sub.add_parser("export", help="typed Parquet tables from profiles and chunks")
    s.add_argument("--profiles", required=True)
    s.add_argument("--chunks", required=True)
    s.add_argument("--out", required=True)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = build_session()
    if a.command in ("chunk", "analyze", "fidelity"):
        config = EngineConfig(
            max_tokens=a.max_tokens, target_tokens=a.target_tokens, tokenizer_path=a.tokenizer, max_pages_per_batch=a.batch_pages, batch_overlap_pages=a.batch_overlap,
            max_request_mb=a.max_request_mb, outline_concurrency=a.outline_concurrency, chunk_concurrency=a.chunk_concurrency,
        )
        pages = _pages(spark, a.documents, a.plain)
    if a.command == "chunk":
        maps = a.profiles or f"{a.out}/profiles"
        state = None
        if a.resume:
            before = readers.read_chunks(spark, f"{a.out}/chunks").withColumnRenamed("source_file", "doc_id")
            p = readers.read_profiles(spark, maps).withColumnRenamed("source_file", "doc_id")
            # read before the same folders are written
            state = pipeline.resumed(materialize(p, "profiles"), materialize(before, "chunks-before"))
        r = pipeline.run(pages, config, resume=state, fidelity=not a.no_fidelity)
        writers.write_chunks(named(r.chunks), f"{a.out}/chunks")
        writers.write_profiles(named(r.profiles), maps, named(r.fidelity) if r.fidelity is not None else None)
        if r.flags is not None:
            for name, df in (("sections", r.section_scores), ("flags", r.flags), ("hints", r.hints)):
                writers.write_chunks(named(df), f"{a.out}/fidelity/{name}")
        print(usage_summary(usage_totals(r.usage, list(COUNTERS))))
    elif a.command == "analyze":
        profiles, sections, used = pipeline.analyze(pages, config)
        writers.write_profiles(named(profiles.join(pipeline.section_lists(sections), "doc_id", "left")), f"{a.out}/profiles")
        print(usage_summary(usage_totals(used, list(COUNTERS))))
    elif a.command == "fidelity":
        c = readers.read_chunks(spark, a.chunks).withColumnRenamed("source_file", "doc_id")
        if a.profiles:
            p, s, _ = pipeline.resumed(readers.read_profiles(spark, a.profiles).withColumnRenamed("source_file", "doc_id"), c)
            for name, df in zip(("documents", "sections", "flags", "hints"), pipeline.scores(pages, p, s, c), strict=True):
                writers.write_chunks(named(df), f"{a.out}/fidelity/{name}")
        else:
            score = Q.score(Q.bag(pages, ["doc_id"]), Q.bag(c, ["doc_id"]), ["doc_id"], pages)
            writers.write_chunks(Q.scan_gate(pages).join(score, "doc_id"), f"{a.out}/fidelity")
    elif a.command == "view":
        c = readers.read_chunks(spark, a.chunks)
        c = c.where(F.col("source_file") == a.source_file) if a.source_file else c
        with open(a.out, "w", encoding="utf-8") as f:
            f.write(writers.review_page({"source_file": a.source_file or ""}, c))
    elif a.command == "serve":
        from pagewright.streaming.incremental import emit, watch_documents

        parse = readers.text_pages if a.plain else readers.pdf_pages

        def chunks_of(documents):
            pages = readers.page_texts(documents, parse).withColumnRenamed("source_file", "doc_id")
            return named(pipeline.run(pages, fidelity=False).chunks)

        q = emit(watch_documents(spark, a.folder), chunks_of, a.out, a.checkpoint, a.once)
        q.awaitTermination()
    else:
        from pagewright.operators import export as X

        p = readers.read_profiles(spark, a.profiles)
        p = X.with_document_id(p)
        c = readers.read_chunks(spark, a.chunks)
        key = p.withColumn("doc_id", F.col("source_file"))
        rows = X.chunk_rows(p.select("export_id", "source_file", "title", "doc_type", "plan_name", "sponsor", "effective_dates"), c)
        sec = key.select("doc_id", F.posexplode("sections").alias("sec_ord", "s")).select("doc_id", "sec_ord", "s.*")
        glo = key.select("doc_id", F.posexplode("glossary").alias("term_ord", "g")).select("doc_id", "term_ord", F.col("term_ord").alias("term_id"), "g.*")
        flat = key.drop("sections", "glossary")
        print(json.dumps(writers.write_export(a.out, rows, X.document_rows(flat, sec, glo, rows), X.glossary_rows(flat, glo))))
    release(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
