"""Readers: binary documents, JSON profiles and chunk lines, Parquet."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.schemas import CHUNK, PROFILE


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, n_bytes, content) of whole binary files; the size is pushed to the file listing."""
    d = spark.read.format("binaryFile").load(path)
    return d.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), F.col("length").alias("n_bytes"), "content")


def pdf_pages(content: bytes) -> list[str]:
    """Text of each page with the optional PDF library; a page that can't be read is empty."""
    try:
        from io import BytesIO

        from pypdf import PdfReader
    except ImportError as e:
        raise RuntimeError("reading PDF files needs the optional pypdf package") from e
    out = []
    for page in PdfReader(BytesIO(content)).pages:
        try:
            out.append(page.extract_text() or "")
        except Exception:  # noqa: BLE001 - malformed pages count as image-only
            out.append("")
    return out


def text_pages(content: bytes) -> list[str]:
    """Pages of a plain text file, separated by form feeds."""
    return content.decode("utf-8", "replace").split("\f")


def page_texts(documents: DataFrame, parser: Callable[[bytes], list[str]] = pdf_pages) -> DataFrame:
    """(source_file, page_no, text): the text layer; a document that can't be parsed gives no page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(s, i, t) for s, c in zip(b["source_file"], b["content"], strict=True) for i, t in enumerate(parser(bytes(c)), 1)]
            yield pd.DataFrame(rows, columns=["source_file", "page_no", "text"])

    return documents.select("source_file", "content").mapInPandas(run, "source_file string, page_no int, text string")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk lines with the defaults of missing fields; blank lines are skipped, lines without a text
    (and lines that aren't JSON) are kept in no row. Extra fields are ignored."""
    c = spark.read.schema(CHUNK).json(path).where("text is not null")
    strings = {f: "" for f in ("source_file", "section_title", "section_summary")} | {"section_type": "unknown"}
    for f in ("keywords", "cross_references"):
        c = c.withColumn(f, F.coalesce(f, F.array().cast("array<string>")))
    return c.na.fill(strings)


def read_raw_chunks(spark: SparkSession, path: str) -> DataFrame:
    """(line) as variant objects: fields that the schema doesn't know survive."""
    t = spark.read.text(path).where("trim(value) <> ''")
    return t.select(F.try_parse_json("value").alias("line")).where("line is not null")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Document maps, JSON documents with a blank line between them, with the defaults of missing fields."""
    t = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"(?<=\})\s*\n\s*\n(?=\s*\{)")).alias("v")).where("trim(v) <> ''")
    p = t.select(F.from_json("v", PROFILE).alias("p")).select("p.*")
    p = p.na.fill({"doc_type": "unknown", "page_count": 0} | {f: "" for f in ("source_file", "title", "plan_name", "sponsor", "notes")})
    for f in ("effective_dates", "cross_references"):
        p = p.withColumn(f, F.coalesce(f, F.array().cast("array<string>")))
    p = p.withColumn("sections", F.coalesce("sections", F.from_json(F.lit("[]"), PROFILE["sections"].dataType)))
    return p.withColumn("glossary", F.coalesce("glossary", F.from_json(F.lit("[]"), PROFILE["glossary"].dataType)))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
