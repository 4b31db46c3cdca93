"""Record types of the document model and of the export tables."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _INT, _LIST = T.StringType(), T.IntegerType(), T.ArrayType(T.StringType())


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in kinds.items()])


SECTION = _struct(title=_STR, section_type=_STR, summary=_STR, page_start=_INT, page_end=_INT)
TERM = _struct(term=_STR, definition=_STR)
PROFILE = _struct(
    source_file=_STR, page_count=_INT, doc_type=_STR, title=_STR, plan_name=_STR, sponsor=_STR, effective_dates=_LIST,
    sections=T.ArrayType(SECTION), glossary=T.ArrayType(TERM), cross_references=_LIST, notes=_STR,
)
CHUNK = _struct(
    text=_STR, source_file=_STR, chunk_index=_INT, section_title=_STR, section_type=_STR, section_summary=_STR,
    page_start=_INT, page_end=_INT, keywords=_LIST, cross_references=_LIST, token_count=_INT,
)
RAW_CHUNK = _struct(text=_STR, keywords=_LIST, cross_references=_LIST, page_start=_INT, page_end=_INT)
OUTLINE = _struct(
    doc_type=_STR, title=_STR, plan_name=_STR, sponsor=_STR, effective_dates=_LIST, sections=T.ArrayType(SECTION),
    glossary=T.ArrayType(TERM), cross_references=_LIST, notes=_STR,
)
EXPORT_CHUNKS = _struct(
    id=_STR, doc_id=_STR, source_file=_STR, text=_STR, embedding_text=_STR, doc_type=_STR, title=_STR, plan_name=_STR,
    sponsor=_STR, effective_dates=_LIST, section_title=_STR, section_type=_STR, section_summary=_STR, page_start=_INT,
    page_end=_INT, keywords=_LIST, cross_references=_LIST, token_count=_INT,
)
EXPORT_DOCUMENTS = _struct(
    doc_id=_STR, source_file=_STR, title=_STR, doc_type=_STR, plan_name=_STR, sponsor=_STR, effective_dates=_LIST,
    page_count=_INT, section_count=_INT, chunk_count=_INT, sections_json=_STR, glossary_json=_STR, cross_references=_LIST, notes=_STR,
)
EXPORT_GLOSSARY = _struct(id=_STR, doc_id=_STR, term=_STR, definition=_STR, embedding_text=_STR)
