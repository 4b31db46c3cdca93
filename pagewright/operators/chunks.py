"""Cleaning, deduplicating, sizing and packing of raw chunks.

Raw chunks have doc, sec, ord and text (and optionally keywords, cross_references, page_start,
page_end). Greedy folds run over unit counts inside one expression and keep only the positions at
which a new piece starts; texts are joined afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.functions.counters import Counter, pack_exactly
from pagewright.session import materialize

DEDUP_MIN_WORDS = 25
_RUN = 256


def clean_raw_chunks(df: DataFrame, section_type: str = "section_type") -> DataFrame:
    """Drop contents lists in unmapped sections, strip dot leaders everywhere."""
    toc = F.coalesce(F.col(section_type) == "unmapped", F.lit(False)) & F.coalesce(T.is_toc_text(F.col("text")), F.lit(False))
    return df.where(~toc).withColumn("text", T.strip_dot_leaders(F.col("text")))


def dedupe_raw_chunks(df: DataFrame, keys: list[str], ord_col: str = "ord", min_words: int = DEDUP_MIN_WORDS) -> DataFrame:
    """Within each section (`keys`), in reading order: drop blank chunks and verbatim repetitions, then
    every paragraph of at least `min_words` words that stood earlier in the section; texts that lost a
    paragraph are joined anew, chunks with nothing left are dropped.

    Only hashes of chunks and paragraphs are grouped and compared; the texts meet the result, the
    positions to remove, in one join. `ord` is unique in its section. A chunk that paragraph removal
    empties still counts as the first of its kind."""

    def digest(c: Column) -> Column:
        return F.unhex(F.md5(c.cast("binary")))

    def mark(x: Column, i: Column) -> Column:
        return F.struct(i.alias("pos"), F.when(T.space_words(x) >= min_words, digest(T.dedup_key(x))).alias("k"))

    long = lambda: F.filter(F.transform(T.paragraphs(F.col("text")), mark), lambda x: x["k"].isNotNull())
    whole = T.dedup_key(F.col("text"))
    # one pass computes all digests; they and the texts have several consumers
    d = materialize(df.withColumn("__c", F.when(F.col("text").isNotNull(), digest(whole))).withColumn("__ps", long()), "raw-chunks")
    d = d.where(F.col("__c") != digest(F.lit("")))
    n = d.select(*keys, ord_col, F.col("__c").alias("c"), F.col("__ps").alias("ps"))
    n = n.groupBy(*keys, "c").agg(F.min_by(F.struct(ord_col, "ps"), ord_col).alias("f")).select(*keys, F.col("f")[ord_col].alias(ord_col), F.col("f.ps").alias("ps"))
    p = n.select(*keys, ord_col, F.explode("ps").alias("p")).select(*keys, ord_col, "p.pos", "p.k")
    seen = p.groupBy(*keys, "k").agg(F.min(F.struct(ord_col, "pos")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys, "k", "f")
    again = p.join(seen, [*keys, "k"]).where(F.col("f") != F.struct(ord_col, "pos"))
    again = again.groupBy(*keys, ord_col).agg(F.collect_set("pos").alias("__gone"))
    kept = n.select(*keys, ord_col).join(again, [*keys, ord_col], "left")
    left = F.filter(T.paragraphs(F.col("text")), lambda x, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n\n"))
    # only texts that lost a paragraph can be empty now
    d = d.drop("__c", "__ps").join(kept, [*keys, ord_col]).where(F.col("__gone").isNull() | (T.strip(text) != ""))
    return d.withColumn("text", text).drop("__gone")


def fold_starts(units: Column, groups: Column, limit: int) -> Column:
    """0-based positions at which a greedy packing of `units` starts a new piece: at the first, where
    the group changes, and where the piece's size would exceed `limit`."""
    zero = F.lit(0).cast("int")
    none = F.array().cast("array<int>")
    start = F.struct(zero.alias("i"), zero.alias("acc"), F.lit(None).cast("int").alias("g"), none.alias("s"), F.array().cast("array<array<int>>").alias("d"))
    pairs = F.arrays_zip(units.alias("u"), groups.alias("g"))

    def step(a: Column, x: Column) -> Column:
        u = x.getField("u").cast("int")
        g = x.getField("g").cast("int")
        new = (a["i"] == 0) | (a["g"] != g) | (T.size_of_units(a["acc"] + u) > limit)
        full = new & (F.size(a["s"]) >= _RUN)  # appending copies the list, so that it is kept in runs
        return F.struct(
            (a["i"] + 1).alias("i"),
            F.when(new, u).otherwise(a["acc"] + u).alias("acc"),
            g.alias("g"),
            F.when(full, F.array(a["i"])).when(new, F.array_append(a["s"], a["i"])).otherwise(a["s"]).alias("s"),
            F.when(full, F.array_append(a["d"], a["s"])).otherwise(a["d"]).alias("d"),
        )

    return F.aggregate(pairs, start, step, lambda a: F.concat(F.flatten(a["d"]), a["s"]))


def _pieces(texts: Column, starts: Column, sep: str) -> Column:
    ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(texts)))
    return F.transform(
        F.arrays_zip(starts.alias("b"), ends.alias("e")),
        lambda p: F.array_join(F.slice(texts, p.getField("b") + 1, p.getField("e") - p.getField("b")), sep),
    )


def split_long_sentence(df: DataFrame, text: str, limit: int, out: str = "pieces") -> DataFrame:
    """Greedy packing of whole words; a word over the limit stands alone."""
    d = df.withColumn("__w", F.regexp_extract_all(F.col(text), F.lit(f"{T.NON_SPACE}+"), F.lit(0)))
    d = d.withColumn("__s", fold_starts(F.transform("__w", T.unit_count), F.transform("__w", lambda x: F.lit(0)), limit))
    return d.withColumn(out, _pieces(F.col("__w"), F.col("__s"), " ")).drop("__w", "__s")


def enforce_token_limit(df: DataFrame, limit: int, text: str = "text", out: str = "pieces") -> DataFrame:
    """Array of pieces within `limit`: the text itself where it fits, else whole sentences packed
    greedily; a sentence over the limit is cut at white space and stands for itself."""
    sent = T.sentences(F.col(text))
    big = T.token_count(F.col(text)) > limit

    def atoms(s: Column, i: Column) -> Column:
        def atom(x: Column, g: Column) -> Column:
            return F.struct(x.alias("t"), T.unit_count(x).alias("u"), g.cast("int").alias("g"))

        ws = F.regexp_extract_all(s, F.lit(f"{T.NON_SPACE}+"), F.lit(0))
        return F.when(T.token_count(s) > limit, F.transform(ws, lambda w: atom(w, i))).otherwise(F.array(atom(s, F.lit(-1))))

    d = df.withColumn("__a", F.when(big, F.flatten(F.transform(sent, atoms))))
    field = lambda f: F.transform("__a", lambda x: x[f])
    d = d.withColumn("__s", fold_starts(field("u"), field("g"), limit))
    cut = _pieces(field("t"), F.col("__s"), " ")
    whole = F.col("__a").isNull() | (F.size("__a") == 0)
    return d.withColumn(out, F.when(whole, F.array(F.col(text))).otherwise(cut)).drop("__a", "__s")


def pack_groups(df: DataFrame, keys: list[str], ord_col: str, target: int, text: str = "text", units: str | None = None) -> DataFrame:
    """(keys, ord, grp): the greedy packing of each section's pieces up to `target`, `grp` from 0 without
    holes. Only order and unit count of the pieces of one section meet, not their texts; `units` names a column
    with the counts."""
    n = df.select(*keys, ord_col, (F.col(units) if units else T.unit_count(F.col(text))).alias("u"))
    s = n.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(ord_col).alias("o"), "u"))).alias("a"))
    s = s.withColumn("s", fold_starts(F.transform("a", lambda x: x["u"]), F.transform("a", lambda x: F.lit(0)), target))
    s = s.select(*keys, "a", F.posexplode_outer(F.arrays_zip(F.col("s").alias("b"), F.concat(F.slice("s", 2, F.size("s")), F.array(F.size("a"))).alias("e"))).alias("grp", "p"))
    b, e = F.col("p").getField("b"), F.col("p").getField("e")
    return s.select(*keys, "grp", F.explode(F.slice("a", b + 1, e - b)).alias("x")).select(*keys, F.col("x.o").alias(ord_col), "grp")


def pack_chunks(df: DataFrame, keys: list[str], ord_col: str, target: int, groups: DataFrame | None = None, about: list[str] | None = None) -> DataFrame:
    """Merge consecutive pieces of a section up to `target`: texts joined by a blank line, keywords and
    references united in order, page range widest (page 0 and null are missing). `groups` as of `pack_groups`; its
    columns `about`, equal in a section, come with the packed chunks."""
    d = df.join(pack_groups(df, keys, ord_col, target) if groups is None else groups, [*keys, ord_col])
    about = about or []
    packed = d.groupBy(*keys, *about, "grp").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    ord_col,
                    F.coalesce("text", F.lit("")).alias("text"),
                    F.coalesce("keywords", F.array()).alias("keywords"),
                    F.coalesce("cross_references", F.array()).alias("refs"),
                )
            )
        ).alias("a"),
        F.min(T.page(F.col("page_start"))).alias("page_start"),
        F.max(T.page(F.col("page_end"))).alias("page_end"),
        F.count(F.lit(1)).alias("n_pieces"),
    )
    field = lambda f: F.transform("a", lambda x: x[f])
    return packed.select(
        *keys,
        *about,
        "grp",
        F.array_join(field("text"), "\n\n").alias("text"),
        F.array_distinct(F.flatten(field("keywords"))).alias("keywords"),
        F.array_distinct(F.flatten(field("refs"))).alias("cross_references"),
        "page_start",
        "page_end",
        "n_pieces",
    )


def normalize_chunk_pages(df: DataFrame, offset: str, sec_start: str, sec_end: str) -> DataFrame:
    """Page ranges of raw chunks: shifted by `offset`; a start outside the section, a missing page or
    an inverted range gives the whole section, else the end is cut at the section's end."""
    s = F.try_add(F.col("page_start"), F.col(offset))
    e = F.try_add(F.col("page_end"), F.col(offset))
    good = F.coalesce((s >= F.col(sec_start)) & (s <= F.col(sec_end)) & (e >= s), F.lit(False))
    d = df.withColumn("__s", F.when(good, s).otherwise(F.col(sec_start)))
    d = d.withColumn("page_end", F.when(good, F.least(e, F.col(sec_end))).otherwise(F.col(sec_end)))
    return d.withColumn("page_start", F.col("__s")).drop("__s")


def assemble_chunks(
    df: DataFrame, doc: str, sec: str, ord_col: str, limit: int = 1024, target: int = 512, start_index: int | str = 0, sec_page: str | None = None, counter: Counter = Counter(), about: DataFrame | None = None
) -> DataFrame:
    """Guard, pack, number and count: the chunks of every document in reading order. Pieces inherit
    keywords, references and pages of the chunk they come from; `sec` orders the sections. `start_index` is the
    number of the first chunk, or the column that holds it. An exact `counter` packs and counts; the guard in front
    of it cuts by the estimate. `about` has one row (doc, sec, columns) of each section, whose columns come with its chunks."""
    # outer explodes throughout: an inner one adds a filter that evaluates the whole fold once more
    d = enforce_token_limit(df, limit).select(*[c for c in df.columns if c != "text"], F.posexplode_outer("pieces").alias("__p", "text"))
    d = d.withColumn("o", F.struct(F.col(ord_col).alias("a"), F.col("__p").alias("b"))).drop(ord_col)
    d = materialize(d.withColumn("__u", T.unit_count(F.col("text"))), "pieces")  # counts and texts both start from it
    keys = [doc, sec, *([sec_page] if sec_page else []), *([start_index] if isinstance(start_index, str) else [])]
    if counter.exact:
        groups = pack_exactly(d.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("o"))), keys, "__n", min(target, limit), counter)
        numbered = d.select(*keys, "o", F.row_number().over(Window.partitionBy(*keys).orderBy("o")).alias("__n"))
        groups = numbered.join(groups, [*keys, "__n"]).select(*keys, "o", "grp")
    else:
        groups = pack_groups(d, keys, "o", min(target, limit), units="__u")
    groups = materialize(groups, "groups")
    # numbers from counts per section: no text passes the window
    w = Window.partitionBy(doc).orderBy(*keys[1:])
    start_index = F.col(start_index) if isinstance(start_index, str) else F.lit(start_index)
    n = groups.groupBy(*keys).agg((F.max("grp") + 1).alias("n"))
    first = n.select(*keys, (F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n") + start_index).alias("__first"))
    # what is said of a section joins its groups, which hold no text
    first = first if about is None else first.join(about, [doc, sec])
    packed = pack_chunks(d.drop("__u", "__p"), keys, "o", min(target, limit), groups.join(first, keys), [c for c in first.columns if c not in keys])
    if sec_page:
        packed = packed.withColumn("page_start", F.coalesce("page_start", sec_page)).withColumn("page_end", F.coalesce("page_end", sec_page))
    packed = packed.withColumn("chunk_index", (F.col("__first") + F.col("grp")).cast("int")).drop("__first")
    return packed.withColumn("token_count", counter.count(F.col("text")))
