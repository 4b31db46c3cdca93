"""Small cases with expected results spelled out."""

import pytest
from pyspark.sql import functions as F

from pagewright.functions import text as T
from pagewright.operators import chunks as C
from pagewright.operators import curate as U
from pagewright.operators import export as X
from pagewright.operators import fidelity as Q
from pagewright.operators import grounding as G
from pagewright.operators import outline as O
from pagewright.operators import pages as P


def sec(spark, rows):
    return spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "doc_id int, ord int, title string, section_type string, summary string, page_start int, page_end int")


def ranges(df):
    return sorted((r.page_start, r.page_end, r.title) for r in df.collect())


def test_overlapping_sections_merge(spark):
    got = O.merge_sections(sec(spark, [("Eligibility", "a", "short", 1, 5), ("ELIGIBILITY ", "b", "a longer one", 5, 8), ("Claims", "c", "", 9, 12)])).collect()
    got = {r.title: r for r in got}
    assert (got["Eligibility"].page_start, got["Eligibility"].page_end, got["Eligibility"].summary, got["Eligibility"].section_type) == (1, 8, "a longer one", "a")
    assert len(got) == 2


def test_interleaved_duplicates_merge(spark):
    assert ranges(O.merge_sections(sec(spark, [("X", "", "", 45, 50), ("Y", "", "", 46, 48), ("X", "", "", 46, 55)]))) == [(45, 55, "X"), (46, 48, "Y")]


def test_gaps_are_filled_and_ranges_held(spark):
    d = spark.createDataFrame([(1, 10)], "doc_id int, page_count int")
    assert ranges(O.fill_gaps(sec(spark, [("A", "", "", 3, 4), ("B", "", "", 7, 8)]), d)) == [
        (1, 2, "Unmapped pages 1-2"), (3, 4, "A"), (5, 6, "Unmapped pages 5-6"), (7, 8, "B"), (9, 10, "Unmapped pages 9-10"),
    ]
    assert ranges(O.fill_gaps(sec(spark, [("B", "", "", 9, 99)]), d))[-1] == (9, 10, "B")


def test_batches(spark):
    d = spark.createDataFrame([("a", 120), ("b", 40), ("c", 0), ("d", None)], "doc_id string, page_count int")
    got = [(r.doc_id, r.page_start, r.page_end) for r in P.plan_batches(d).orderBy("doc_id", "batch_no").collect()]
    assert got == [("a", 1, 50), ("a", 50, 99), ("a", 99, 120), ("b", 1, 40)]
    with pytest.raises(ValueError):
        P.plan_batches(d, most=0)


def test_references(spark):
    d = spark.createDataFrame([(1, i, r) for i, r in enumerate([", Section 2", " ", "section  2", "— Part B", None])], "k int, pos int, ref string")
    assert sorted(r.ref for r in O.sanitize_references(d, "k", "ref", ["pos"]).collect()) == ["Part B", "Section 2"]


@pytest.mark.parametrize(
    "text, want",
    [("Eligibility ........ 3 Claims ....... 8 Appeals ...... 12 Notes .. 9", True), ("Pay .... 3 and .... 4 only", False)],
)
def test_contents_lists(spark, text, want):
    assert spark.range(1).select(T.is_toc_text(F.lit(text))).first()[0] is want


def test_counting_is_unicode(spark):
    texts = ["", "naïve café", "a_b, c!", "保険 x", "a\x0bb", "١٢", "x y"]
    import re

    d = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in d.select("t", T.token_count(F.col("t")).alias("n")).collect():
        assert r.n == int(len(re.findall(r"\w+|[^\w\s]", r.t)) * 1.3) + 1, r.t


def test_sql_functions_equal_columns(spark):
    T.register(spark)
    t = "  Naïve   .....  “Section” 4 \n"
    for name, f in (("pw_strip", T.strip), ("pw_match_key", T.match_key), ("pw_token_count", T.token_count), ("pw_dedup_key", T.dedup_key), ("pw_strip_dot_leaders", T.strip_dot_leaders), ("pw_normalize_title", T.normalize_title), ("pw_is_toc_text", T.is_toc_text)):
        d = spark.createDataFrame([(t,)], "t string")
        assert d.select(f(F.col("t"))).first()[0] == d.selectExpr(f"{name}(t)").first()[0], name


def test_enforce_and_pack(spark):
    d = spark.createDataFrame([(1, "One two three. Four five six. " + "w " * 30)], "id int, text string")
    pieces = C.enforce_token_limit(d, 12).first().pieces
    assert pieces[0] == "One two three. Four five six." or pieces[0].startswith("One")
    size = lambda t: int(len(__import__("re").findall(r"\w+|[^\w\s]", t)) * 1.3) + 1
    assert all(size(p) <= 12 for p in pieces)
    assert " ".join(pieces).split() == d.first().text.split()


def test_dedupe_keeps_first_long_paragraph(spark):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, 0, f"{long}\n\nshort"), (1, 1, f"{long.upper()}\n\nother"), (1, 2, "short"), (1, 3, "  SHORT "), (1, 4, " "), (1, 5, long), (2, 0, long)]
    d = spark.createDataFrame(rows, "sec int, ord int, text string")
    got = {(r.sec, r.ord): r.text for r in C.dedupe_raw_chunks(d, ["sec"]).collect()}
    assert got == {(1, 0): f"{long}\n\nshort", (1, 1): "other", (1, 2): "short", (2, 0): long}


def test_relative_pages(spark):
    d = spark.createDataFrame([(1, 2, 4, 5, 8), (3, 4, 4, 5, 8), (9, 9, 4, 5, 8), (None, 2, 4, 5, 8), (3, 9, 4, 5, 8)], "page_start int, page_end int, off int, s int, e int")
    got = [(r.page_start, r.page_end) for r in C.normalize_chunk_pages(d, "off", "s", "e").collect()]
    assert got == [(5, 6), (7, 8), (5, 8), (5, 8), (7, 8)]


def test_scores(spark):
    r = spark.createDataFrame([("a", "x y z w"), ("b", "pay period"), ("c", "one")], "k string, text string")
    c = spark.createDataFrame([("a", "x y q q"), ("b", "pay pay period")], "k string, text string")
    got = {x.k: (round(x.coverage, 2), round(x.novelty, 2)) for x in Q.score(Q.bag(r, ["k"]), Q.bag(c, ["k"]), ["k"]).collect()}
    assert got == {"a": (0.5, 0.5), "b": (1.0, 0.33), "c": (0.0, 0.0)}


def test_shared_pages(spark):
    s = spark.createDataFrame([(1, 0, 1, 3), (1, 1, 3, 5), (1, 2, 6, 7), (1, 3, 6, 6), (1, 4, 9, 9)], "doc_id int, sec_no int, page_start int, page_end int")
    assert {r.sec_no: r.shared for r in O.shared_pages(s).collect()} == {0: True, 1: True, 2: True, 3: True, 4: False}


def test_section_grounding(spark):
    pages = spark.createDataFrame([(1, 1, "Handbook"), (1, 2, "Eligibility Claims Process Appeals Rules"), (1, 3, "Eligibility rules start here"), (1, 4, "more"), (1, 5, "Claims process text")], "doc_id int, page_no int, text string")
    s = spark.createDataFrame([(1, 10, 0, "Eligibility", 1, 2), (1, 11, 1, "Claims Process", 3, 5), (1, 12, 2, "Appeals Rules", 9, 9)], "doc_id int, section_id int, ord int, title string, page_start int, page_end int")
    got = {r.section_id: (r.page_start, r.page_end, r.grounded) for r in G.ground_sections(s, pages).collect()}
    assert got[10] == (3, 4, True) and got[11][0] == 5 and got[12] == (9, 9, False)


def test_chunk_grounding(spark):
    pages = spark.createDataFrame([(1, 1, "first page text about nothing"), (1, 2, "the quick brown fox jumps over it"), (1, 3, "lazy dogs sleep in the evening sun")], "doc_id int, page_no int, text string")
    c = spark.createDataFrame([(1, 1, "quick brown fox jumps", 1, 1, 1, 3), (1, 2, "lazy dogs sleep in the", 1, 1, 1, 1), (1, 3, "tiny", 1, 1, 1, 3)], "doc_id int, chunk_id int, text string, page_start int, page_end int, sec_start int, sec_end int")
    got = {r.chunk_id: (r.page_start, r.page_end) for r in G.ground_chunks(c, pages).collect()}
    assert got == {1: (2, 2), 2: (3, 3), 3: (1, 1)}


def test_export_counts_duplicates(spark):
    p = spark.createDataFrame([("f.pdf", "T", "spd", "T Plan", None, ["2020"])], "source_file string, title string, doc_type string, plan_name string, sponsor string, effective_dates array<string>")
    rows = [(i, "f.pdf", i, t, "S", "x", "", 1, 1, None, [], 3) for i, t in enumerate(["one", "one", " ", "two"])]
    c = spark.createDataFrame(rows, "chunk_id int, source_file string, chunk_index int, text string, section_title string, section_type string, section_summary string, page_start int, page_end int, keywords array<string>, cross_references array<string>, token_count int")
    got = {r.text: (r.n_copies, r.embedding_text) for r in X.chunk_rows(p, c).collect()}
    assert got == {"one": (2, "Document: T — T Plan\nSection: S\none"), "two": (1, "Document: T — T Plan\nSection: S\ntwo")}


def test_upsert(spark):
    s = "id int, doc_id string, embedding_text string"
    t = spark.createDataFrame([(1, "a", "x", 1.0), (2, "a", "y", 2.0), (3, "a", "gone", 3.0), (4, "b", "stays", 4.0)], s + ", embedding double")
    i = spark.createDataFrame([(1, "a", "x"), (2, "a", "new"), (5, "c", "z")], s)
    assert sorted(tuple(r) for r in X.upsert(t, i).collect()) == [(1, "a", "x", 1.0), (2, "a", "new", None), (4, "b", "stays", 4.0), (5, "c", "z", None)]


def test_cost_is_null_for_unknown_models(spark):
    t = spark.createDataFrame([("small-1", 10, 20), ("big-2", 1, 1)], "model string, a bigint, b bigint")
    r = spark.createDataFrame([("small", 1, 1.0, 2.0)], "prefix string, ord int, rate_a double, rate_b double")
    assert U.usage_cost(t, r, ["a", "b"]).first().cost is None
    assert U.usage_cost(t.where("a = 10"), r, ["a", "b"]).first().cost == pytest.approx(50 / 1e6)


def test_resume(spark):
    s = spark.createDataFrame([(1, "S1", 0), (1, "S2", 1), (1, "S3", 2)], "doc_id int, title string, ord int")
    c = spark.createDataFrame([(1, "S1", 7), (1, "S1", 9), (1, "S3", 11)], "doc_id int, section_title string, chunk_index int")
    assert U.completed_prefix(s, c, "doc_id").first().done == 1
    assert sorted(r.chunk_index for r in U.resume_plan(s, c, "doc_id").collect()) == [0, 1]


def test_rows_of_a_nameless_record_share_their_id(spark):
    from pagewright.operators import export as X

    p = spark.createDataFrame([(1, None, None, "t", None, None, [], 3, [], None)], "doc_id int, source_file string, title string, doc_type string, plan_name string, sponsor string, effective_dates array<string>, page_count int, cross_references array<string>, notes string")
    g = spark.createDataFrame([(1, 0, 5, "Plan", ""), (1, 1, 6, "Fee", "a sum"), (1, 2, 7, "PLAN", "later")], "doc_id int, term_ord int, term_id int, term string, definition string")
    s = spark.createDataFrame([], "doc_id int, sec_ord int, title string, section_type string, summary string, page_start int, page_end int")
    c = spark.createDataFrame([], "source_file string, chunk_index int, text string, section_title string, section_type string, section_summary string, page_start int, page_end int, keywords array<string>, cross_references array<string>, token_count int")
    p = X.with_document_id(p)
    terms = X.glossary_rows(p, g).collect()
    assert sorted((t.term, t.embedding_text) for t in terms) == [("Fee", "Fee: a sum"), ("Plan", "Plan")]
    rows = X.chunk_rows(p, c)
    assert {t.doc_id for t in terms} == {r.doc_id for r in X.document_rows(p, s, g, rows).collect()}


def test_chunks_of_two_files_with_the_same_numbers(spark):
    from pagewright.operators import export as X

    p = spark.createDataFrame([("a.pdf", "A", "t", "", "", []), ("b.pdf", "B", "t", "", "", [])], "source_file string, title string, doc_type string, plan_name string, sponsor string, effective_dates array<string>")
    rows = [("a.pdf", 0, "x"), ("a.pdf", 1, "y"), ("a.pdf", 2, "x"), ("b.pdf", 0, "x"), ("b.pdf", 1, "z")]
    c = spark.createDataFrame([(f, i, t, "", "", "", 1, 1, [], [], 1) for f, i, t in rows], "source_file string, chunk_index int, text string, section_title string, section_type string, section_summary string, page_start int, page_end int, keywords array<string>, cross_references array<string>, token_count int")
    got = X.chunk_rows(p, c).collect()
    assert sorted((r.source_file, r.text, r.n_copies) for r in got) == [("a.pdf", "x", 2), ("a.pdf", "y", 1), ("b.pdf", "x", 1), ("b.pdf", "z", 1)]
    assert len({r.id for r in got}) == 4


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_words_of_chunks_meet_pages_once(spark):
    """The driver's memory follows the size of the plan: one join of words, one group per chunk."""
    lines = ["orchid basil clover damask elderberry", "falcon garnet heather indigo juniper", "kestrel lavender marigold nutmeg orchid"]
    pages = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(lines)], "doc_id int, page_no int, text string")
    c = spark.createDataFrame([(1, i, x, 1, None if i else 3) for i, x in enumerate(lines)], "doc_id int, chunk_id int, text string, sec_start int, sec_end int")
    d = G.locate_by_words(c, pages)
    assert sorted(map(tuple, d.select("chunk_id", "span_start", "span_end").collect())) == [(0, 1, 1), (1, 2, 2), (2, 3, 3)]
    assert _exchanges(d) <= 4


def test_chunk_grounding_has_a_small_plan(spark):
    """Edges and lost chunks are written once; before, the plan held both searches for each of their uses."""
    pages = spark.createDataFrame([(1, n, f"Only page {n} holds the words number {n} of this document.") for n in range(1, 200)], "doc_id int, page_no int, text string")
    c = spark.createDataFrame(
        [(1, 1, "Only page 70 holds the words number 70 of this document.", 1, 1, 1, 2**31 - 1), (1, 2, "Only page 3 holds the words number 3 of this", 9, 9, 2, 4), (2, 1, "a document without any page", 5, 6, 5, 6)],
        "doc_id int, chunk_id int, text string, page_start int, page_end int, sec_start int, sec_end int",
    )
    g = G.ground_chunks(c, pages)
    got = sorted(map(tuple, g.select("doc_id", "chunk_id", "page_start", "page_end").collect()))
    assert got == [(1, 1, 70, 70), (1, 2, 3, 3), (2, 1, 5, 6)]
    assert _exchanges(g) <= 12


def test_section_grounding_has_a_small_plan(spark):
    """What the titles show on the pages is written once; before, every use of it was planned again."""
    texts = ["Plan Claims Appeals Funding", "Claims", "Appeals start", "rules of the funding board", "zebra quagga", "quagga zebra okapi"]
    pages = spark.createDataFrame([(1, i + 1, x) for i, x in enumerate(texts)], "doc_id int, page_no int, text string")
    titles = ["Claims", "Appeals", "Funding", "Okapi: Quagga Zebra", "no such title"]
    s = spark.createDataFrame([(1, i, i, x, 1, 6) for i, x in enumerate(titles)], "doc_id int, section_id int, ord int, title string, page_start int, page_end int")
    g = G.ground_sections(s, pages)
    got = {r.section_id: (r.page_start, r.grounded) for r in g.collect()}
    assert got == {0: (2, True), 1: (3, True), 2: (4, True), 3: (6, True), 4: (1, False)}
    assert _exchanges(g) <= 16


def test_words_of_large_documents_meet_in_several_groups(spark, monkeypatch):
    """Words travel once in rows of pages and chunks, never alone; before, a row for each word of both was shuffled, and a
    page delivered twice counted twice."""
    lines = [" ".join(f"w{n}a{k:02d}x common" for k in range(12)) for n in range(1, 9)]
    rows = [(d, n, x) for d in ("a", "b") for n, x in enumerate(lines, 1) for _ in range(4 if n == 3 else 1)]
    pages = spark.createDataFrame(rows, "doc_id string, page_no int, text string")
    c = [(d, (1, n), x + " unseen", n, None if n % 2 else n) for d in ("a", "b") for n, x in enumerate(lines, 1)]
    c += [("a", (2, 1), lines[0], 7, 8), ("a", (2, 2), "common", 1, 8), ("c", (1, 1), lines[0], 1, 1), (None, (1, 1), lines[0], 1, 1), ("b", (2, 3), None, 1, 8)]
    c = spark.createDataFrame(c, "doc_id string, chunk_id struct<sec:int,ord:int>, text string, sec_start int, sec_end int")
    want = sorted((d, (1, n), n, n) for d in ("a", "b") for n in range(1, 9))
    for most in (G.GROUP_CHARS, 300, 40):
        monkeypatch.setattr(G, "GROUP_CHARS", most)
        monkeypatch.setattr(G, "WORD_BYTES", 8_000_000 if most > 300 else 1)
        d = G.locate_by_words(c, pages)
        assert sorted((r.doc_id, tuple(r.chunk_id), r.span_start, r.span_end) for r in d.collect()) == want
        assert "word#" not in d._jdf.queryExecution().executedPlan().toString()
