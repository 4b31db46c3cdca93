"""DuckDB spellings of the text functions, for the oracle statements."""

from __future__ import annotations

from pagewright.functions.text import NON_SPACE, SPACE, UNIT


def rep(x: str, pattern: str, to: str = "") -> str:
    p = pattern.replace("'", "''")
    return f"regexp_replace({x}, '{p}', '{to}', 'g')"


def strip(x: str) -> str:
    return rep(x, f"^{SPACE}+|{SPACE}+$")


def collapse(x: str) -> str:
    return strip(rep(x, f"{SPACE}+", " "))


def match_key(x: str) -> str:
    return rep(f"lower({x})", "[^a-z0-9]+")


def count(x: str, pattern: str) -> str:
    p = pattern.replace("'", "''")
    return f"len(regexp_extract_all({x}, '{p}'))"


def units(x: str) -> str:
    return count(x, UNIT)


def size_of(n: str) -> str:
    return f"(CAST(floor({n} * 1.3) AS INTEGER) + 1)"


def tokens(x: str) -> str:
    return size_of(units(x))


def words(x: str, least: int = 1) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9]" + ("+" if least == 1 else "{%d,}" % least) + "')"


def space_words(x: str) -> str:
    return count(x, f"{NON_SPACE}+")


def dedup_key(x: str) -> str:
    return f"lower({collapse(x)})"


def leaders(x: str) -> str:
    return strip(rep(rep(x, r"\.{4,}", " "), r"[ \t]{2,}", " "))


def is_toc(x: str) -> str:
    e = count(x, r"\.{4,}[\s.]*[0-9]+")
    return f"({e} >= 3 AND {space_words(leaders(x))} <= 12 * {e})"


def title_key(x: str) -> str:
    return rep(f"lower({rep(x, f'{SPACE}+', ' ')})", r'^[" .:\-–—]+|[" .:\-–—]+$')


def content_id(prefix: str, x: str) -> str:
    return f"'{prefix}' || substr(sha1({x}), 1, 16)"


#: Rows delivered again count once.
BASE = """
WITH prof AS (SELECT DISTINCT ON (doc_id) * FROM profiles ORDER BY doc_id, loaded_at),
sec AS (SELECT DISTINCT ON (section_id) * FROM sections ORDER BY section_id, loaded_at),
chk AS (SELECT DISTINCT ON (chunk_id) * FROM chunks ORDER BY chunk_id, created_at),
glo AS (SELECT DISTINCT ON (term_id) * FROM glossary ORDER BY term_id, loaded_at)"""

#: Pages of PAGE_LINES lines each.
PAGE_LINES = 3
PAGES = f"""doc_lines AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
doc_pages AS (SELECT doc_id, unnest(range(1, (len(a) + {PAGE_LINES - 1}) // {PAGE_LINES} + 1)) AS page_no, a FROM doc_lines),
pages AS (SELECT doc_id, CAST(page_no AS INTEGER) AS page_no,
          array_to_string(a[(page_no - 1) * {PAGE_LINES} + 1:page_no * {PAGE_LINES}], chr(10)) AS text FROM doc_pages)"""
