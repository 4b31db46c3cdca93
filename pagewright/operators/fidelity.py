"""How well chunks cover their source, and what they hold beyond it: multisets of words.

Both sides are counted in one aggregate per word (reference and candidate as two sums), so a score
takes no join; sums combine before every shuffle, and keys always hold the word, which spreads large
documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.session import materialize

#: Scores that warn, the least text layer, chunk and line sizes (fixed values).
COVERAGE_LOW, NOVELTY_HIGH, MIN_LAYER = 0.85, 0.15, 200
CHUNK_MIN_WORDS, LINE_MIN_WORDS, LINE_ABSENT, MOST_LINES = 20, 4, 0.5, 3
#: Everything that ends a line.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
#: Texts of the hints (fixed values).
MISATTRIBUTED, NOT_IN_LAYER = "misattributed pages", "not in the text layer of any page"


def bag(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, word, n): the words of each key's texts with their number."""
    # an outer explode: the inner one would evaluate the words once more in a filter of its own
    w = df.select(*keys, F.explode_outer(T.words(F.col(text))).alias("word")).where("word is not null")
    return w.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def score(reference: DataFrame, candidate: DataFrame, keys: list[str], all_keys: DataFrame | None = None) -> DataFrame:
    """(keys, matched, ref_words, cand_words, coverage, novelty) from two bags.

    Coverage is 1 for an empty reference, novelty 0 for an empty candidate. Keys of `all_keys` without
    words on either side are kept."""
    zero = F.lit(0).cast("bigint")
    both = reference.select(*keys, "word", F.col("n").alias("r"), zero.alias("c")).unionByName(
        candidate.select(*keys, "word", zero.alias("r"), F.col("n").alias("c"))
    )
    per = both.groupBy(*keys, "word").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    s = per.groupBy(*keys).agg(F.sum(F.least("r", "c")).alias("matched"), F.sum("r").alias("ref_words"), F.sum("c").alias("cand_words"))
    if all_keys is not None:
        s = all_keys.select(*keys).distinct().join(s, keys, "left").na.fill(0, ["matched", "ref_words", "cand_words"])
    m, r, c = F.col("matched"), F.col("ref_words"), F.col("cand_words")
    return s.withColumn("coverage", F.when(r == 0, F.lit(1.0)).otherwise(m / r)).withColumn("novelty", F.when(c == 0, F.lit(0.0)).otherwise(1 - m / c))


def scan_gate(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, layer_chars, status): documents whose text layer is too thin to be scored are 'skipped'."""
    s = pages.groupBy(key).agg(F.sum(F.length(T.strip(F.col("text")))).alias("layer_chars"))
    return s.withColumn("status", F.when(F.col("layer_chars") < MIN_LAYER, "skipped").otherwise("ok"))


def opened(ranges: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """Adds page_no: each range held within the document's pages and opened; documents without pages
    give no row."""
    last = pages.groupBy(key).agg(F.max("page_no").alias("__n"))
    d = ranges.join(last, key)
    start = F.greatest(F.lit(1), F.least("page_start", "__n"))
    end = F.greatest(start, F.least("page_end", "__n"))
    return d.withColumn("page_no", F.explode(F.sequence(start, end))).drop("__n")


def range_bag(ranges: DataFrame, pages: DataFrame, key: str, ident: list[str]) -> DataFrame:
    """(ident, word, n): the words of each range's pages. Page bags are counted once and met by
    (document, page)."""
    o = opened(ranges.select(key, *ident, "page_start", "page_end"), pages, key)
    j = o.join(bag(pages, [key, "page_no"]), [key, "page_no"])
    return j.groupBy(*ident, "word").agg(F.sum("n").alias("n"))


def score_sections(sections: DataFrame, chunks: DataFrame, pages: DataFrame, key: str = "doc_id", ident: str = "sec_no") -> DataFrame:
    """Score of each section: its pages against the chunks that name its title (sections of one title
    share them)."""
    ref = range_bag(sections.select(key, ident, "page_start", "page_end"), pages, key, [key, ident])
    by_title = bag(chunks.where("section_title is not null"), [key, "section_title"])
    cand = sections.select(key, ident, F.col("title").alias("section_title")).join(by_title, [key, "section_title"]).select(key, ident, "word", "n")
    return score(ref, cand, [key, ident], sections)


def warnings(scores: DataFrame, section_type: str = "section_type", shared: str = "shared") -> DataFrame:
    """Adds warn_coverage and warn_novelty: none where pages are shared, none for the coverage of
    unmapped sections."""
    free = ~F.col(shared)
    low = free & (F.coalesce(F.col(section_type), F.lit("")) != "unmapped") & (F.col("coverage") < COVERAGE_LOW)
    return scores.withColumn("warn_coverage", low).withColumn("warn_novelty", free & (F.col("novelty") > NOVELTY_HIGH))


def line_counts(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, line_no, word, n) of the lines with enough words."""
    lines = chunks.select(*keys, F.posexplode_outer(F.split("text", LINE_END)).alias("line_no", "line"))
    lines = lines.withColumn("w", T.words(F.col("line"))).where(F.size("w") >= LINE_MIN_WORDS)
    return lines.select(*keys, "line_no", F.explode_outer("w").alias("word")).groupBy(*keys, "line_no", "word").agg(F.count(F.lit(1)).alias("n"))


def words_on_pages(chunks: DataFrame, pages: DataFrame, key: str = "doc_id", ident: str = "chunk_id", without_pages: bool = True) -> DataFrame:
    """(key, ident, word, n, there): how often each word of each chunk stands in it and on the chunk's pages. The chunk's
    range is held within the document's pages; of documents without pages no word stands anywhere, or they are left
    out.

    Per (document, word) the counts of the pages are summed up in page order, and each chunk reads the sum at its
    end and before its start: the rows are those of the chunks' and the pages' words, however wide a range is."""
    last = pages.groupBy(key).agg(F.max("page_no").alias("__n"))
    c = chunks.join(last, key, "left" if without_pages else "inner")
    start = F.greatest(F.lit(1), F.least("page_start", "__n"))
    c = c.select(key, ident, (start - 1).alias("__lo"), F.greatest(start, F.least("page_end", "__n")).alias("__hi"), "text")
    ends = F.array(F.struct(F.col("__lo").alias("at"), F.lit(None).cast("bigint").alias("n")), F.struct(F.col("__hi").alias("at"), F.col("n").alias("n")))
    asked = bag(c, [key, ident, "__lo", "__hi"]).select(key, "word", ident, F.explode(ends).alias("e"))
    asked = asked.select(key, "word", "e.at", F.lit(1).alias("ask"), ident, "e.n", F.lit(0).cast("bigint").alias("held"))
    none = F.lit(None).cast(chunks.schema[ident].dataType).alias(ident)
    held = bag(pages, [key, "page_no"]).select(key, "word", F.col("page_no").alias("at"), F.lit(0).alias("ask"), none, F.lit(None).cast("bigint").alias("n"), F.col("n").alias("held"))
    w = Window.partitionBy(key, "word").orderBy("at", "ask").rowsBetween(Window.unboundedPreceding, 0)
    sums = held.unionByName(asked).withColumn("upto", F.sum("held").over(w)).where("ask = 1")
    return sums.groupBy(key, ident, "word").agg(F.max("n").alias("n"), (F.max("upto") - F.min("upto")).alias("there"))


def _novel(chunks: DataFrame, words: DataFrame, key: str, ident: str) -> DataFrame:
    """(key, ident, line_no, words, absent) of the lines half of whose words or more aren't on the pages. Only chunks
    with such words are split into lines."""
    gone = words.where("there = 0").groupBy(key, ident).agg(F.collect_set("word").alias("gone"))

    def line(t: Column, i: Column) -> Column:
        return F.struct(i.alias("line_no"), T.words(t).alias("w"))

    d = chunks.select(key, ident, "text").join(gone, [key, ident]).withColumn("l", F.transform(F.split("text", LINE_END), line))
    d = d.withColumn("l", F.filter("l", lambda x: F.size(x["w"]) >= LINE_MIN_WORDS))
    absent = lambda x: F.size(F.filter(x["w"], lambda y: F.array_contains("gone", y)))
    d = d.withColumn("l", F.transform("l", lambda x: F.struct(x["line_no"].alias("line_no"), F.size(x["w"]).alias("words"), absent(x).alias("absent"))))
    d = d.select(key, ident, F.explode_outer(F.filter("l", lambda x: x["absent"] / x["words"] >= LINE_ABSENT)).alias("l"))
    return d.select(key, ident, "l.*").where("line_no is not null")


def novel_lines(chunks: DataFrame, pages: DataFrame, key: str = "doc_id", ident: str = "chunk_id") -> DataFrame:
    """(key, ident, line_no, words, absent) of the lines half of whose words or more aren't on the chunk's
    pages."""
    return _novel(chunks, words_on_pages(chunks, pages, key, ident), key, ident)


def scored_chunks(chunks: DataFrame, unmapped: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """The chunks that are scored: long enough, and not of an unmapped title (key, section_title)."""
    d = chunks.where((T.space_words(F.col("text")) >= CHUNK_MIN_WORDS) & F.col("page_start").isNotNull() & F.col("page_end").isNotNull())
    return d.join(unmapped, [key, "section_title"], "left_anti") if unmapped is not None else d


def novelty_flags(chunks: DataFrame, pages: DataFrame, key: str = "doc_id", ident: str = "chunk_id") -> DataFrame:
    """(key, ident, novelty, n_lines, first_lines): chunks with much text that isn't on their pages, or with
    a novel line. `first_lines` are the 0-based numbers of the first three. Documents without pages give no row."""
    words = materialize(words_on_pages(chunks, pages, key, ident, False), "chunk-words")
    s = words.groupBy(key, ident).agg(F.sum(F.least("n", "there")).alias("matched"), F.sum("n").alias("total"))
    lines = _novel(chunks, words, key, ident).groupBy(key, ident).agg(F.array_sort(F.collect_list("line_no")).alias("l"))
    d = s.join(lines, [key, ident], "left")
    found = F.coalesce("l", F.array().cast("array<int>"))
    d = d.select(key, ident, (1 - F.col("matched") / F.col("total")).alias("novelty"), F.size(found).alias("n_lines"), F.slice(found, 1, MOST_LINES).alias("first_lines"))
    return d.where((F.col("novelty") > NOVELTY_HIGH) | (F.col("n_lines") > 0))


def locate_lines(lines: DataFrame, novel: DataFrame, pages: DataFrame, key: str = "doc_id", ident: str = "chunk_id") -> DataFrame:
    """(key, ident, line_no, hint): where else in the document each novel line stands. `lines` as of
    `line_counts`."""
    w = lines.join(novel.select(key, ident, "line_no", "words"), [key, ident, "line_no"])
    pw = bag(pages, [key, "page_no"]).select(key, "page_no", "word")
    on = w.join(pw, [key, "word"]).groupBy(key, ident, "line_no", "page_no").agg(F.sum("n").alias("there"), F.first("words").alias("words"))
    on = on.where((F.col("words") - F.col("there")) / F.col("words") < LINE_ABSENT)
    hits = on.groupBy(key, ident, "line_no").agg(F.array_sort(F.collect_list("page_no")).alias("p"))
    d = novel.select(key, ident, "line_no").join(hits, [key, ident, "line_no"], "left")
    shown = F.array_join(F.transform(F.slice("p", 1, 3), lambda x: x.cast("string")), ", ")
    found = F.concat(F.lit("found on page "), shown, F.when(F.size("p") > 3, "+").otherwise(""), F.lit(f" ({MISATTRIBUTED})"))
    none = F.lit(f"{NOT_IN_LAYER} (invented, or the text layer is incomplete there)")
    return d.select(key, ident, "line_no", F.when(F.col("p").isNull(), none).otherwise(found).alias("hint"))


def quality_summary(document: DataFrame, flags: DataFrame, hints: DataFrame, key: str = "doc_id", ident: str = "chunk_id") -> DataFrame:
    """Per document: whether its scores hold, flagged chunks, and what their first three hints say."""
    f = flags.groupBy(key).agg(F.count(F.lit(1)).alias("flagged_chunks"))
    shown = flags.select(key, ident, F.explode("first_lines").alias("line_no")).join(hints, [key, ident, "line_no"])
    h = shown.groupBy(key).agg(
        F.count_if(F.contains("hint", F.lit("misattributed"))).alias("flags_misattributed"),
        F.count_if(F.contains("hint", F.lit("not in the text layer"))).alias("flags_not_in_layer"),
    )
    d = document.join(f, key, "left").join(h, key, "left").na.fill(0, ["flagged_chunks", "flags_misattributed", "flags_not_in_layer"])
    return d.select(
        key,
        (F.col("coverage") >= COVERAGE_LOW).alias("coverage_ok"),
        (F.col("novelty") <= NOVELTY_HIGH).alias("novelty_ok"),
        "flagged_chunks",
        "flags_misattributed",
        "flags_not_in_layer",
    )


def ratio(c: Column) -> Column:
    """Four decimals, for reports only."""
    return F.round(c, 4)
