"""Reconciling partial document maps into one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators.intervals import coverage

UNMAPPED = "unmapped"
UNMAPPED_SUMMARY = "Pages outside every mapped section."


def first_nonempty(df: DataFrame, key: str, order: str, cols: list[str], empty: dict[str, str] | None = None) -> DataFrame:
    """Per key the first value in `order` that isn't blank, stripped; else '' or `empty[col]`."""
    aggs = []
    for c in cols:
        v = F.nullif(T.strip(F.col(c)), F.lit(""))
        # rows without a value have a null order and are passed over
        first = F.min_by(v, F.when(v.isNotNull(), F.struct(F.col(order), v)))
        aggs.append(F.coalesce(first, F.lit((empty or {}).get(c, ""))).alias(c))
    return df.groupBy(key).agg(*aggs)


def distinct_first(df: DataFrame, keys: list[str], identity: str, order: list[str], cols: list[str]) -> DataFrame:
    """One row per (keys, identity): that of the smallest `order`. Aggregation combines before the
    shuffle, so a value that a third of the rows repeat doesn't meet in one task."""
    row = F.min_by(F.struct(*cols), F.struct(*order)).alias("r")
    d = df.groupBy(*keys, identity).agg(row, F.min(F.struct(*order)).alias("o"))
    return d.select(*keys, identity, *[F.col(f"r.{c}").alias(c) for c in cols], *[F.col(f"o.{c}").alias(c) for c in order if c not in cols])


def dedupe_strings(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """Distinct strings per key without regard to case and white space; the first, stripped, stays."""
    d = df.withColumn("__k", T.dedup_key(F.col(value))).where("__k <> ''").withColumn(value, T.strip(F.col(value)))
    return distinct_first(d, [key], "__k", order, [value]).drop("__k")


def sanitize_references(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """`dedupe_strings` of cross-references without leading punctuation."""
    return dedupe_strings(df.withColumn(value, T.clean_reference(F.col(value))).where(F.col(value).isNotNull()), key, value, order)


def merge_glossary(df: DataFrame, key: str = "doc_id", order: list[str] | None = None) -> DataFrame:
    """One definition per term: terms are equal without case and outer white space, the first wins
    and keeps its spelling. Blank terms are no terms."""
    d = df.withColumn("__k", F.lower(T.strip(F.col("term")))).where("__k <> ''")
    return distinct_first(d, [key], "__k", order or ["term_ord", "term_id"], ["term", "definition"]).drop("__k")


def repair_ranges(df: DataFrame) -> DataFrame:
    """Ranges with a missing page get the other one (1 where both are missing), inverted ones end
    where they start."""
    s = F.coalesce("page_start", "page_end", F.lit(1))
    d = df.withColumn("page_start", s)
    return d.withColumn("page_end", F.greatest(F.coalesce("page_end", "page_start"), "page_start"))


def merge_sections(sections: DataFrame, key: str = "doc_id", ord_col: str = "ord") -> DataFrame:
    """Fold sections of one title whose ranges overlap or touch: union range, longest summary (first on
    ties), title and type of the first in page order. Needs well-formed ranges (`repair_ranges`).
    Output: key, title, section_type, summary, page_start, page_end, ord."""
    d = sections.withColumn("__t", F.coalesce(T.normalize_title(F.col("title")), F.lit("")))
    order = ["page_start", "page_end", ord_col]
    w = Window.partitionBy(key, "__t").orderBy(*order)
    reach = F.max("page_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    d = d.withColumn("__new", (reach.isNull() | (F.col("page_start") > reach + 1)).cast("int"))
    d = d.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.struct(*order)
    longest = F.struct((-F.length(F.coalesce("summary", F.lit("")))).alias("n"), first.alias("o"))
    return (
        d.groupBy(key, "__t", "__run")
        .agg(
            F.min_by("title", first).alias("title"),
            F.min_by("section_type", first).alias("section_type"),
            F.min_by("summary", longest).alias("summary"),
            F.min("page_start").alias("page_start"),
            F.max("page_end").alias("page_end"),
            F.min(first)[ord_col].alias(ord_col),
        )
        .drop("__t", "__run")
    )


def fill_gaps(sections: DataFrame, docs: DataFrame, key: str = "doc_id", pages: str = "page_count") -> DataFrame:
    """Sections clamped to [1, pages], and one synthetic section per maximal uncovered page run.
    Documents without pages keep their sections as they are. Output as `merge_sections`."""
    n = docs.groupBy(key).agg(F.max(pages).alias("__n"))
    d = sections.join(n, key, "left")
    some = F.coalesce(F.col("__n") > 0, F.lit(False))
    start = F.when(some, F.least(F.greatest("page_start", F.lit(1)), "__n")).otherwise(F.col("page_start"))
    end = F.when(some, F.least(F.greatest("page_end", F.lit(1)), "__n")).otherwise(F.col("page_end"))
    d = d.withColumn("__s", start.cast("int")).withColumn("__e", F.greatest(end, start).cast("int"))
    d = d.withColumn("page_start", F.col("__s")).withColumn("page_end", F.col("__e")).drop("__n", "__s", "__e")
    domain = n.where("__n > 0").select(key, F.lit(1).alias("lo"), F.col("__n").alias("hi"))
    gaps = coverage(d, domain, key).where("span_kind = 'gap'")
    s, e = F.col("span_start").cast("int"), F.col("span_end").cast("int")
    made = gaps.select(
        key,
        F.concat(F.lit("Unmapped pages "), s.cast("string"), F.lit("-"), e.cast("string")).alias("title"),
        F.lit(UNMAPPED).alias("section_type"),
        F.lit(UNMAPPED_SUMMARY).alias("summary"),
        s.alias("page_start"),
        e.alias("page_end"),
        F.lit(None).cast("int").alias("ord"),
    )
    return d.select(*made.columns).unionByName(made)


def number_sections(sections: DataFrame, key: str = "doc_id") -> DataFrame:
    """Adds sec_no, the place in page order within the document, from 0."""
    w = Window.partitionBy(key).orderBy("page_start", "page_end", F.col("ord").asc_nulls_last(), "title")
    return sections.withColumn("sec_no", (F.row_number().over(w) - 1).cast("int"))


def reconcile(sections: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Repair, merge, fill and number the sections of all documents."""
    return number_sections(fill_gaps(merge_sections(repair_ranges(sections), key), docs, key), key)


def shared_pages(sections: DataFrame, key: str = "doc_id", ident: str = "sec_no") -> DataFrame:
    """Adds shared: whether the section has a page that another section has too. Start counts per
    page replace a page-by-page count of all sections: pages are pre-aggregated per (document, page)."""
    pages = sections.select(key, ident, F.explode(F.sequence("page_start", "page_end")).alias("__p"))
    owned = pages.groupBy(key, "__p").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    hit = pages.join(owned, [key, "__p"]).select(key, ident).distinct().withColumn("shared", F.lit(True))
    return sections.join(hit, [key, ident], "left").withColumn("shared", F.coalesce("shared", F.lit(False)))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
