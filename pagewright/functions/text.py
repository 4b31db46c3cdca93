"""Text functions as column expressions: they fuse into the surrounding projection.

Word characters and white space are spelled as Unicode classes, because the plain classes of the
JVM are ASCII only.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: One counted unit: a run of word characters, or a single other sign.
UNIT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x{85}\p{Z}]"
ASCII_UNIT = r"[A-Za-z0-9_]+|[!-/:-@\[-^`{-~\x00-\x08\x0e-\x1b\x7f]"
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
NON_SPACE = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
TOKENS_PER_UNIT = 1.3
PARAGRAPH_BREAK = r"\n\s*\n"
SENTENCE = r"[^.!?]+[.!?]*"
#: Contents lines: entries and words per entry.
TOC_MIN_ENTRIES, TOC_MAX_WORDS = 3, 12


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(c, f"{SPACE}+", " "))


def clean(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def match_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def unit_count(c: Column) -> Column:
    """Texts of ASCII signs take the ASCII classes, which the JVM tests by a table."""
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, F.regexp_count(c, F.lit(ASCII_UNIT))).otherwise(F.regexp_count(c, F.lit(UNIT)))


def size_of_units(n: Column) -> Column:
    """Token estimate of a text with `n` units. Units never hold white space, so the units of a
    joined text are the sum of the units of its parts."""
    return (F.floor(n * F.lit(TOKENS_PER_UNIT)) + 1).cast("int")


def token_count(c: Column) -> Column:
    return size_of_units(unit_count(c))


def ascii_token_count(c: Column) -> Column:
    """The estimate of the curation page, whose word class is ASCII."""
    n = F.regexp_count(c, F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s\x0b\x{85}\p{Z}\x{feff}]"))
    return size_of_units(n)


def words(c: Column, least: int = 1) -> Column:
    """All words of at least `least` letters or digits, in order."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+" if least == 1 else "[a-z0-9]{%d,}" % least), F.lit(0))


def space_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(f"{NON_SPACE}+"))


def dedup_key(c: Column) -> Column:
    return F.lower(collapse(c))


def strip_dot_leaders(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"\.{4,}", " "), r"[ \t]{2,}", " "))


def is_toc_text(c: Column) -> Column:
    entries = F.regexp_count(c, F.lit(r"\.{4,}[\s.]*[0-9]+"))
    return (entries >= TOC_MIN_ENTRIES) & (space_words(strip_dot_leaders(c)) <= entries * TOC_MAX_WORDS)


def paragraphs(c: Column) -> Column:
    return F.split(c, PARAGRAPH_BREAK)


def sentences(c: Column) -> Column:
    parts = F.transform(F.regexp_extract_all(c, F.lit(SENTENCE), F.lit(0)), strip)
    return F.filter(parts, lambda x: x != "")


def content_id(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(c.cast("binary")), 1, 16))


def normalize_title(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(c, f"{SPACE}+", " ")), r'^[" .:\-–—]+|[" .:\-–—]+$', "")


def clean_reference(c: Column) -> Column:
    """A cross-reference without leading punctuation; null when nothing is left."""
    return F.nullif(strip(F.regexp_replace(strip(c), r"^[,;:.\-–— ]+", "")), F.lit(""))


def distinct_in_order(c: Column) -> Column:
    return F.array_distinct(c)


def encoded_size(n_bytes: Column) -> Column:
    """Bytes of the base64 form."""
    return F.floor((n_bytes + 2) / 3).cast("bigint") * 4


def page(c: Column) -> Column:
    """Page numbers of 0 are missing ones."""
    return F.nullif(c, F.lit(0))


_SQL = {
    "pw_strip": "s",
    "pw_match_key": "s",
    "pw_token_count": "s",
    "pw_dedup_key": "s",
    "pw_strip_dot_leaders": "s",
    "pw_is_toc_text": "s",
    "pw_normalize_title": "s",
    "pw_encoded_size": "n",
}
_TYPES = {"s": "STRING", "n": "BIGINT"}


def register(spark: SparkSession) -> list[str]:
    """Make the functions callable from SQL, as temporary SQL functions that Catalyst inlines."""
    for name, kind in _SQL.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x {_TYPES[kind]}) RETURN {sql_of(name)}")
    return list(_SQL)


def _q(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_of(name: str) -> str:
    """The SQL body of a registered function."""
    ends = _q(f"^{SPACE}+|{SPACE}+$")
    leaders = f"regexp_replace(regexp_replace(regexp_replace(x, {_q(chr(92) + '.{4,}')}, ' '), {_q('[ ' + chr(92) + 't]{2,}')}, ' '), {ends}, '')"
    entries = "regexp_count(x, " + _q(r"\.{4,}[\s.]*[0-9]+") + ")"
    return {
        "pw_strip": f"regexp_replace(x, {ends}, '')",
        "pw_match_key": "regexp_replace(lower(x), '[^a-z0-9]+', '')",
        "pw_token_count": f"cast(floor(regexp_count(x, {_q(UNIT)}) * 1.3D) + 1 as int)",
        "pw_dedup_key": f"lower(regexp_replace(regexp_replace(x, {_q(SPACE + '+')}, ' '), {ends}, ''))",
        "pw_strip_dot_leaders": leaders,
        "pw_is_toc_text": f"{entries} >= {TOC_MIN_ENTRIES} and regexp_count({leaders}, {_q(NON_SPACE + '+')}) <= {entries} * {TOC_MAX_WORDS}",
        "pw_normalize_title": f"regexp_replace(lower(regexp_replace(x, {_q(SPACE + '+')}, ' ')), "
        + _q(r'^[" .:\-–—]+|[" .:\-–—]+$')
        + ", '')",
        "pw_encoded_size": "cast(floor((x + 2) / 3) as bigint) * 4",
    }[name]
