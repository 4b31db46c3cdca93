"""Page ranges: batches, slices and their sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plan_batches(docs: DataFrame, n: str = "page_count", most: int = 50, overlap: int = 1) -> DataFrame:
    """Overlapping page ranges of fixed size: adds batch_no (from 0), page_start, page_end.

    The overlap is held within [0, most - 1]. Documents with null pages or none give no row. The
    ranges follow from a closed form, so nothing is looped over."""
    if most < 1:
        raise ValueError("a batch needs at least one page")
    stride = most - min(max(overlap, 0), most - 1)
    pages = F.col(n)
    last = F.when(pages <= most, F.lit(0)).otherwise(F.ceil((pages - most) / F.lit(stride))).cast("int")
    d = docs.where(pages > 0).withColumn("batch_no", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("batch_no") * stride
    return d.withColumn("page_start", start + 1).withColumn("page_end", F.least(start + most, pages))


def slice_pages(pages: DataFrame, ranges: DataFrame, key: str = "doc_id") -> DataFrame:
    """The pages of each range. The range is opened into its pages, so the join is an equi-join on
    (document, page) and no document's pages meet all of its ranges."""
    opened = ranges.withColumn("page_no", F.explode(F.sequence("page_start", "page_end")))
    return opened.join(pages, [key, "page_no"])


def halve_to_fit(sizes: Column, start: Column, end: Column, budget: int, most_levels: int = 31) -> Column:
    """Array of (s, e) ranges of [start, end], halved at their middle until the encoded size of each
    is within `budget` or it is one page. `sizes` is the array of page sizes in bytes, page 1 first.
    One expression: every step splits all ranges that are still too large."""

    def encoded(r: Column) -> Column:
        total = F.aggregate(F.slice(sizes, r["s"], r["e"] - r["s"] + 1), F.lit(0).cast("bigint"), lambda a, x: a + x)
        return F.floor((total + 2) / 3).cast("bigint") * 4

    def halves(r: Column) -> Column:
        mid = F.floor((r["s"] + r["e"]) / 2).cast("int")
        both = F.array(F.struct(r["s"].alias("s"), mid.alias("e")), F.struct((mid + 1).alias("s"), r["e"].alias("e")))
        return F.when((r["s"] == r["e"]) | (encoded(r) <= budget), F.array(r)).otherwise(both)

    levels = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(most_levels), F.ceil(F.log2(end - start + 1)).cast("int") + 1)))
    return F.aggregate(levels, F.array(F.struct(start.alias("s"), end.alias("e"))), lambda acc, _: F.flatten(F.transform(acc, halves)))


def page_sizes(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, sizes): bytes of every page in order; numbers only, no text is gathered."""
    p = pages.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page_no", F.octet_length("text").cast("bigint").alias("n")))).alias("a"))
    return p.select(key, F.transform("a", lambda x: x["n"]).alias("sizes"))


def slice_to_fit(pages: DataFrame, ranges: DataFrame, budget: int, key: str = "doc_id") -> DataFrame:
    """The ranges (key, page_start, page_end and others) cut so that each slice's encoded size is at
    most `budget`; adds slice_no, slice_start, slice_end, fits (false for one page over budget)."""
    d = ranges.join(page_sizes(pages, key), key)
    d = d.select(
        *ranges.columns,
        "sizes",
        F.posexplode(halve_to_fit(F.col("sizes"), F.col("page_start"), F.col("page_end"), budget)).alias("slice_no", "r"),
    )
    total = F.aggregate(F.slice("sizes", F.col("r.s"), F.col("r.e") - F.col("r.s") + 1), F.lit(0).cast("bigint"), lambda a, x: a + x)
    fits = F.floor((total + 2) / 3).cast("bigint") * 4 <= budget
    return d.select(*ranges.columns, "slice_no", F.col("r.s").alias("slice_start"), F.col("r.e").alias("slice_end"), fits.alias("fits"))


def iter_batches(pages: DataFrame, docs: DataFrame, budget: int, most: int = 50, overlap: int = 1, key: str = "doc_id") -> DataFrame:
    """Batches of `plan_batches`, those over budget cut by `slice_to_fit` (their parts don't overlap)."""
    return slice_to_fit(pages, plan_batches(docs, "page_count", most, overlap), budget, key)


def rebase(df: DataFrame, offset: str, cols: tuple[str, ...] = ("page_start", "page_end")) -> DataFrame:
    """Page numbers relative to a batch as page numbers of the document; missing ones count as 1."""
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(1)) + F.col(offset))
    return df
