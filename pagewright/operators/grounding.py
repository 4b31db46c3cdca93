"""Grounding sections and chunks in the text layer of their pages.

Edges are searched by an equi-join on (document, page): page windows are opened into their few pages,
so neither a huge document's pages meet all of its chunks nor is text copied; only needles of at most 40
characters travel with the windows. The word sets of a document meet in one group, those of a large one
in several, cut by word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.session import materialize

#: Chunk edges: length searched for, least key length, margin in pages.
EDGE, EDGE_MIN_KEY, MARGIN = 40, 15, 3
#: Pages that chunks meet at once, and most blocks of a window whose end isn't looked up.
PAGE_BLOCK, FEW_BLOCKS = 16, 4
#: Word fallback of chunks: most pages of a rare word, least rare words, least share, widest span, neighbour share.
RARE_PAGES, RARE_WORDS, RARE_SHARE, MOST_SPAN, NEIGHBOUR = 3, 5, 0.5, 3, 0.25
#: Characters of a document's pages and chunks whose words meet in one group, most groups of a document, bytes of words that are looked at at once.
GROUP_CHARS, MOST_GROUPS, WORD_BYTES = 4_000_000, 512, 8_000_000
#: Titles: least key length, headings of an index page, characters at the top of a page, rare words.
TITLE_MIN_KEY, INDEX_HEADINGS, TOP_CHARS, TITLE_RARE_PAGES, TITLE_RARE_WORDS = 6, 3, 120, 4, 2


def heading_offset(page_key: Column, title_key: Column) -> Column:
    """0-based offset of the first occurrence not directly behind the word 'section'; null if none."""
    return F.nullif(F.regexp_instr(page_key, F.concat(F.lit("(?<!section)"), title_key)) - 1, F.lit(-1))


def title_hits(sections: DataFrame, pages: DataFrame, key: str, ident: str) -> DataFrame:
    """(key, ident, page_no, offset) of every page on which a section's title stands. Titles of one
    document meet its pages; both sides are keys, not texts."""
    t = sections.select(key, ident, T.match_key(F.col("title")).alias("k")).where(F.length("k") >= TITLE_MIN_KEY)
    p = pages.select(key, "page_no", T.match_key(F.col("text")).alias("pk")).where(F.length("pk") >= TITLE_MIN_KEY)
    j = t.join(p, key).where(F.contains("pk", F.col("k")))
    return j.withColumn("offset", heading_offset(F.col("pk"), F.col("k"))).where("offset is not null").select(key, ident, "page_no", "offset")


def _seen(sections: DataFrame, pages: DataFrame, key: str, ident: str) -> DataFrame:
    """(key, page_no, hits, words) of the pages on which a title or a word of a title stands: hits are the titles with
    their offsets, words those of the document's titles. Pages travel once, to the titles of their document."""
    t = sections.select(key, ident, T.match_key(F.col("title")).alias("k"), F.array_distinct(T.words(F.col("title"), 3)).alias("w")).where(F.length("k") >= TITLE_MIN_KEY)
    titles = F.collect_list(F.struct(F.col(ident).alias("ident"), "k")).alias("titles")
    t = materialize(t.groupBy(key).agg(titles, F.array_distinct(F.flatten(F.collect_list("w"))).alias("wanted")), "titles")
    j = pages.select(key, "page_no", "text").join(t, key)
    j = j.select(key, "page_no", "titles", "wanted", T.match_key(F.col("text")).alias("pk"), F.array_distinct(T.words(F.col("text"), 3)).alias("w"))
    hits = F.transform(F.filter("titles", lambda x: F.contains(F.col("pk"), x["k"])), lambda x: F.struct(x["ident"].alias("ident"), heading_offset(F.col("pk"), x["k"]).alias("offset")))
    one = F.struct(F.filter(hits, lambda x: x["offset"].isNotNull()).alias("hits"), F.array_intersect("w", "wanted").alias("words"))
    return j.select(key, "page_no", F.explode_outer(F.array(one)).alias("s")).select(key, "page_no", "s.hits", "s.words").where("size(hits) + size(words) > 0")


def ground_sections(sections: DataFrame, pages: DataFrame, key: str = "doc_id", ident: str = "section_id", ord_col: str = "ord") -> DataFrame:
    """Section starts snapped to the one page that holds their heading, ends to the next heading.

    Pages with three or more headings are index pages and ground nothing. A title without a single
    page is looked for by its rare words. Output: `sections` with new ranges and `grounded`."""
    seen = materialize(_seen(sections, pages, key, ident), "titles-seen")
    plain = seen.where(F.size("hits") < INDEX_HEADINGS)
    real = plain.select(key, "page_no", F.explode("hits").alias("h")).select(key, F.col("h.ident").alias(ident), "page_no", "h.offset")
    one = real.groupBy(key, ident).agg(F.count(F.lit(1)).alias("n"), F.min("page_no").alias("__p"), F.min("offset").alias("__off")).where("n = 1").drop("n")
    one = materialize(one, "headings")
    # rare words of the titles that have no single heading
    rest = sections.join(one, [key, ident], "left_anti").where(F.length(T.match_key(F.col("title"))) >= TITLE_MIN_KEY)
    want = rest.select(key, ident, F.explode_outer(F.array_distinct(T.words(F.col("title"), 3))).alias("word")).where("word is not null")
    on = seen.select(key, F.struct("page_no", (F.size("hits") >= INDEX_HEADINGS).alias("index")).alias("on"), F.explode("words").alias("word"))
    rare = on.groupBy(key, "word").agg(F.collect_list("on").alias("on")).where(F.size("on") <= TITLE_RARE_PAGES)
    per = want.join(rare, [key, "word"]).select(key, ident, "on").groupBy(key, ident).agg(F.count(F.lit(1)).alias("n"), F.flatten(F.collect_list("on")).alias("on"))
    per = per.where(F.col("n") >= TITLE_RARE_WORDS)
    # the pages with all rare words, but for index pages
    full = lambda x: ~x["index"] & (F.size(F.filter("on", lambda y: y["page_no"] == x["page_no"])) == F.col("n"))
    per = per.select(key, ident, F.explode_outer(F.array(F.filter(F.array_distinct("on"), full))).alias("p")).where(F.size("p") == 1)
    by_words = per.select(key, ident, F.get("p", F.lit(0))["page_no"].alias("__p"), F.lit(0).alias("__off"))
    found = one.unionByName(by_words)
    d = sections.join(found, [key, ident], "left").withColumn("grounded", F.col("__p").isNotNull())
    d = d.withColumn("page_start", F.coalesce("__p", "page_start")).withColumn("page_end", F.greatest("page_start", "page_end"))
    w = Window.partitionBy(key).orderBy("page_start", "page_end", ord_col, ident)
    bound = F.lead("page_start").over(w) - F.when(F.lead("__off").over(w) <= TOP_CHARS, F.lit(1)).otherwise(F.lit(0))
    bound = F.greatest(bound, "page_start")
    d = d.withColumn("__b", F.when(F.lead("grounded").over(w), bound))
    end = F.when(F.col("__b").isNull(), F.col("page_end")).when(F.col("grounded"), F.col("__b")).otherwise(F.least("page_end", "__b"))
    return d.withColumn("page_end", end).drop("__p", "__off", "__b")


def _page_blocks(chunks: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """Adds the narrow (lo, hi) and the wide (wlo, whi) page window, and opens the wide one into the blocks of
    PAGE_BLOCK pages that it touches. Only windows of many blocks, or without an end, are cut at the last page first."""
    lo, hi = F.greatest(F.col("sec_start").cast("bigint"), F.lit(1)), F.col("sec_end").cast("bigint")
    d = chunks.withColumn("lo", lo).withColumn("hi", hi).withColumn("wlo", F.greatest(F.col("sec_start").cast("bigint") - MARGIN, F.lit(1)))
    d = d.withColumn("whi", hi + MARGIN).drop("sec_start", "sec_end")
    few = F.coalesce(F.col("whi") - F.col("wlo") < FEW_BLOCKS * PAGE_BLOCK, F.lit(False))
    last = pages.groupBy(key).agg(F.max("page_no").cast("bigint").alias("last"))
    cut = d.where(~few).join(last, key).withColumn("hi", F.least("hi", "last")).withColumn("whi", F.least("whi", "last")).drop("last")
    d = d.where(few).unionByName(cut).where("wlo <= whi")
    return d.withColumn("block", F.explode(F.sequence(_block(F.col("wlo")), _block(F.col("whi")))))


def _block(page_no: Column) -> Column:
    return F.floor(page_no / F.lit(PAGE_BLOCK)).cast("bigint")


def _grouped_words(chunks: DataFrame, pages: DataFrame, key: str, ident: str) -> DataFrame:
    """(key, part, page_no, ident, lo, hi, words): a row for each page (page_no) and chunk (ident, lo, hi) with its different
    words in one string. Documents of more than GROUP_CHARS characters get several parts, each with the words of
    its own hash, and a row for each part of their pages and chunks."""
    lo, hi = F.greatest(F.col("sec_start").cast("bigint") - MARGIN, F.lit(1)), F.col("sec_end").cast("bigint") + MARGIN
    none = lambda kind: F.lit(None).cast(kind)
    texts = pages.select(key, F.length("text").alias("n")).unionByName(chunks.select(key, F.length("text").alias("n")))
    large = texts.groupBy(key).agg(F.sum("n").alias("n")).where(F.col("n") > GROUP_CHARS)
    large = large.select(key, F.least(F.ceil(F.col("n") / F.lit(GROUP_CHARS)), F.lit(MOST_GROUPS)).cast("int").alias("parts"))
    w = F.array_distinct(T.words(F.col("text"), 4)).alias("w")
    p = pages.select(key, F.col("page_no").cast("int").alias("page_no"), none(chunks.schema[ident].dataType).alias(ident), none("bigint").alias("lo"), none("bigint").alias("hi"), w)
    c = chunks.select(key, none("int").alias("page_no"), ident, lo.alias("lo"), hi.alias("hi"), w)
    d = p.unionByName(c).join(F.broadcast(large), key, "left")
    own = lambda b: F.struct(b.alias("part"), F.array_join(F.filter("w", lambda x: F.pmod(F.xxhash64(x), F.col("parts")) == b), " ").alias("words"))
    parts = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(0).alias("part"), F.array_join("w", " ").alias("words")))).otherwise(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), own))
    # chunks of too few words ask for nothing
    parts = F.when(F.col("page_no").isNotNull() | (F.size("w") >= RARE_WORDS), parts)
    d = d.select(key, "page_no", ident, "lo", "hi", F.explode_outer(parts).alias("g")).select(key, "g.part", "page_no", ident, "lo", "hi", "g.words")
    return d.where(F.col(key).isNotNull() & (F.col("words") != "")).repartition(key, "part").sortWithinPartitions(key, "part", "page_no")


def _rare_sets(key: str, ident: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From the rows of `_grouped_words` to (key, ident, sets): for each chunk the pages that hold its rare words, those
    in its window only, with the number of words that stand on just these (`on`, `n`)."""

    def of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        col = {c: t[c].combine_chunks() for c in t.column_names}
        lists = pc.split_pattern(col["words"], " ")
        sizes = pc.list_value_length(lists).to_numpy()
        words = lists.flatten().dictionary_encode()
        part = col["part"].to_numpy().astype(np.int64)
        group = col[key].dictionary_encode().indices.to_numpy().astype(np.int64) * (part.max() + 1) + part
        code = np.repeat(group, sizes) * len(words.dictionary) + words.indices.to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        is_page = col["page_no"].is_valid().to_numpy(zero_copy_only=False)
        numbers, rank = np.unique(col["page_no"].fill_null(0).to_numpy(), return_inverse=True)
        # the pages of each word, least first; a page delivered twice counts once
        there = is_page[row]
        held, at = code[there], rank[row[there]]
        order = np.lexsort((at, held))
        held, at = held[order], at[order]
        new = np.ones(len(held), bool)
        new[1:] = (held[1:] != held[:-1]) | (at[1:] != at[:-1])
        held, at = held[new], at[new]
        first = np.flatnonzero(np.r_[held[:1] >= 0, held[1:] != held[:-1]])
        df = np.diff(np.r_[first, len(held)])
        first, df = first[df <= RARE_PAGES], df[df <= RARE_PAGES]
        if not len(first):
            return
        # equal sets of pages get one number
        cols = [np.where(df > i, at[np.minimum(first + i, len(at) - 1)] + 1, 0) for i in range(RARE_PAGES)]
        number = cols[0]
        for c in cols[1:]:
            _, some, number = np.unique(number * (len(numbers) + 1) + c, return_index=True, return_inverse=True)
        sets = np.stack([c[some] for c in cols], 1)
        rare, asked, asks = held[first], code[~there], row[~there]
        place = np.minimum(np.searchsorted(rare, asked), len(rare) - 1)
        hit = rare[place] == asked
        pair, n = np.unique(asks[hit] * len(sets) + number[place[hit]], return_counts=True)
        chunk, which = pair // len(sets), sets[pair % len(sets)]
        pages = numbers[np.maximum(which - 1, 0)]
        lo, hi = (col[c].fill_null(v).to_numpy()[chunk][:, None] for c, v in (("lo", 1), ("hi", 2**62)))
        near = (which > 0) & (pages >= lo) & (pages <= hi)
        on = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(near.sum(1))], pa.int32()), pa.array(pages[near], pa.int32()))
        each = pa.StructArray.from_arrays([on, pa.array(n, pa.int32())], names=["on", "n"])
        chunk, start = np.unique(chunk, return_index=True)
        out = pa.ListArray.from_arrays(pa.array(np.r_[start, len(pair)], pa.int32()), each)
        yield pa.RecordBatch.from_arrays([col[key].take(pa.array(chunk)), col[ident].take(pa.array(chunk)), out], names=[key, ident, "sets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[pa.RecordBatch] = []  # whole groups
        last: list[pa.RecordBatch] = []  # the group that may go on
        name = None
        for b in batches:
            if not b.num_rows:
                continue
            ends = b[key][-1], b["part"][-1]
            if last and (b[key][0], b["part"][0]) != name:
                ready, last = ready + last, []
            same = pc.and_(pc.equal(b[key], ends[0]), pc.equal(b["part"], ends[1]))
            cut = pc.index(same, True).as_py()
            if cut:
                ready, last = [*ready, *last, b.slice(0, cut)], []
            last.append(b.slice(cut))
            name = ends
            if sum(x["words"].nbytes for x in ready) >= WORD_BYTES:
                yield from of(pa.Table.from_batches(ready))
                ready = []
        if ready or last:
            yield from of(pa.Table.from_batches(ready + last))

    return run


def _let(value: Column, use) -> Column:
    """use(value) with `value` evaluated once, however often it is used; the optimizer can't inline it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _run(on: str) -> Column:
    """The run of pages that the words point to, as an array of one struct or none; `on` holds the pages of each word."""

    def around(s: Column, best: Column) -> Column:
        p, least = best["p"], F.greatest(F.lit(1), F.floor(-best["m"] * NEIGHBOUR).cast("int"))
        ok = {k: F.coalesce(s[p + k] >= least, F.lit(False)) for k in (-2, -1, 1, 2)}
        left = F.when(ok[-1] & ok[-2], 2).when(ok[-1], 1).otherwise(0)
        room = F.lit(MOST_SPAN - 1) - left
        right = F.when((room >= 2) & ok[1] & ok[2], 2).when((room >= 1) & ok[1], 1).otherwise(0)
        return F.struct((p - left).alias("span_start"), (p + right).alias("span_end"))

    # the words on a page: from its place in the sorted list to the place of the next
    places = lambda a, p: F.transform(p, lambda x: F.array_position(a, x).cast("int"))
    counts = lambda a, at: F.transform(at, lambda x, i: F.coalesce(F.get(at, i + 1), F.size(a) + 1) - x)
    scores = lambda a: _let(F.array_distinct(a), lambda p: F.map_from_arrays(p, _let(places(a, p), lambda at: counts(a, at))))
    best = lambda s: F.array_min(F.transform(F.map_entries(s), lambda e: F.struct((-e["value"]).alias("m"), e["key"].alias("p"))))
    run = _let(_let(F.array_sort(F.flatten(on)), scores), lambda s: _let(best(s), lambda b: around(s, b)))
    inside = lambda r: F.size(F.filter(on, lambda o: F.exists(o, lambda x: x.between(r["span_start"], r["span_end"]))))
    return F.filter(F.array(run), lambda r: r["span_start"].isNotNull() & (inside(r) / F.size(on) >= RARE_SHARE))


def locate_by_words(chunks: DataFrame, pages: DataFrame, key: str = "doc_id", ident: str = "chunk_id") -> DataFrame:
    """(key, ident, span_start, span_end) of the chunks whose rare words point to a run of at most three
    pages. `chunks` has text, sec_start and sec_end; chunks without a clear run give no row.

    Words travel once, in one row per page and chunk, to the group of their document; what follows is one group
    per chunk, of the different sets of at most three pages on which its words stand."""
    words = _grouped_words(chunks, pages, key, ident)
    schema = ", ".join(f"`{c}` {words.schema[c].dataType.simpleString()}" for c in (key, ident)) + ", sets array<struct<on: array<int>, n: int>>"
    sets = words.mapInArrow(_rare_sets(key, ident), schema).groupBy(key, ident).agg(F.flatten(F.collect_list("sets")).alias("sets"))
    sets = sets.where(F.aggregate("sets", F.lit(0), lambda a, x: a + x["n"]) >= RARE_WORDS)
    per = sets.select(key, ident, F.flatten(F.transform("sets", lambda x: F.array_repeat(x["on"], x["n"]))).alias("on"))
    # one outer generator: neither a filter nor a projection on it evaluates the run again
    return per.select(key, ident, F.explode_outer(_run("on")).alias("r")).where("r is not null").select(key, ident, "r.span_start", "r.span_end")


def ground_chunks(chunks: DataFrame, pages: DataFrame, key: str = "doc_id", ident: str = "chunk_id", by_words: bool = True) -> DataFrame:
    """Page ranges of chunks corrected by the text layer.

    `chunks` has text, page_start, page_end, sec_start and sec_end. The first and last 40 letters and
    digits of a chunk are looked for on its section's pages, and within three pages around where they
    stand on none of them; only a single page counts. Where neither is found, rare words decide.
    Texts of fewer than 15 letters and digits and contradictory finds leave the range as it is."""
    needle = chunks.select(key, ident, "sec_start", "sec_end", T.match_key(F.col("text")).alias("k")).where(F.length("k") >= EDGE_MIN_KEY)
    needle = needle.select(key, ident, "sec_start", "sec_end", F.substring("k", 1, EDGE).alias("a"), F.right("k", F.lit(EDGE)).alias("z"))
    keyed = pages.select(key, _block(F.col("page_no")).alias("block"), "page_no", T.match_key(F.col("text")).alias("pk"))
    j = _page_blocks(needle, pages, key).join(keyed, [key, "block"]).where(F.col("page_no").between(F.col("wlo"), F.col("whi")))
    near = (F.col("page_no") >= F.col("lo")) & F.coalesce(F.col("page_no") <= F.col("hi"), F.lit(True))
    edges = []
    for name in ("a", "z"):
        hit = F.contains("pk", F.col(name))
        edges += [
            F.count_if(hit & near).alias(f"{name}n"),
            F.count_if(hit).alias(f"{name}w"),
            F.min(F.when(hit & near, F.col("page_no"))).alias(f"{name}pn"),
            F.min(F.when(hit, F.col("page_no"))).alias(f"{name}pw"),
        ]
    e = j.groupBy(key, ident).agg(*edges)
    pick = lambda c: F.when(F.col(f"{c}n") == 1, F.col(f"{c}pn")).when((F.col(f"{c}n") == 0) & (F.col(f"{c}w") == 1), F.col(f"{c}pw"))
    e = materialize(e.select(key, ident, pick("a").alias("ps"), pick("z").alias("pe")), "edges")
    found = e.where("ps is not null or pe is not null")
    if by_words:
        # written, so that the texts of few lost chunks meet a broadcast; chunks without a page in their window aren't in it
        lost = materialize(e.where("ps is null and pe is null").select(key, ident), "lost-chunks")
        texts = chunks.select(key, ident, "text", "sec_start", "sec_end").join(lost, [key, ident], "left_semi")
        spans = locate_by_words(texts, pages.join(lost.select(key).distinct(), key, "left_semi"), key, ident)
        found = materialize(found.unionByName(spans.select(key, ident, F.col("span_start").alias("ps"), F.col("span_end").alias("pe"))), "found")
    d = chunks.join(found, [key, ident], "left")
    against = F.coalesce(F.col("ps") > F.col("pe"), F.lit(False))
    d = d.withColumn("__s", F.when(against, F.col("page_start")).otherwise(F.coalesce("ps", "page_start")))
    d = d.withColumn("__e", F.when(against, F.col("page_end")).otherwise(F.coalesce("pe", "page_end")))
    wrong = F.coalesce(F.col("__s") > F.col("__e"), F.lit(False)) & ~against
    start = F.when(wrong & F.col("ps").isNull() & F.col("pe").isNotNull(), F.col("pe")).otherwise(F.col("__s"))
    end = F.when(wrong & F.col("ps").isNotNull(), F.col("ps")).otherwise(F.col("__e"))
    d = d.withColumn("page_start", start).withColumn("page_end", end)
    return d.drop("__s", "__e", "ps", "pe")
