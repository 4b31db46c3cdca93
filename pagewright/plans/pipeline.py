"""The whole run as one plan: pages, outline, sections, chunks, scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.config import EngineConfig
from pagewright.functions import text as T
from pagewright.functions.counters import choose_counter
from pagewright.operators import chunks as C
from pagewright.operators import fidelity as Q
from pagewright.operators import grounding as G
from pagewright.operators import outline as O
from pagewright.operators import pages as P
from pagewright.operators.curate import completed_prefix, resume_plan
from pagewright.operators.model_call import COUNTERS, Proposer, RuleProposer, call_rows, call_sections, mode
from pagewright.schemas import OUTLINE, RAW_CHUNK
from pagewright.session import forget, materialize, settle


@dataclass
class RunResult:
    """The tables of a run. `fidelity` scores documents, `section_scores` sections, `flags` are the chunks with text that
    isn't on their pages, `hints` where their lines stand; all are worked out when the first of them is asked for, and
    None without scoring. `profiles` holds the sections, terms, references and dates of each document."""

    profiles: DataFrame
    sections: DataFrame
    chunks: DataFrame
    usage: DataFrame
    scorer: Callable[[], tuple[DataFrame, DataFrame, DataFrame, DataFrame]] | None = None

    @cached_property
    def _scores(self) -> tuple[DataFrame | None, ...]:
        return self.scorer() if self.scorer else (None,) * 4

    @property
    def fidelity(self) -> DataFrame | None:
        return self._scores[0]

    @property
    def section_scores(self) -> DataFrame | None:
        return self._scores[1]

    @property
    def flags(self) -> DataFrame | None:
        return self._scores[2]

    @property
    def hints(self) -> DataFrame | None:
        return self._scores[3]


def _limited(requests: DataFrame, most: int | None) -> DataFrame:
    return requests.repartition(most) if most else requests


def _request(pages: DataFrame, ranges: DataFrame, kind: str, keys: list[str], more: list[str], config: EngineConfig) -> DataFrame:
    """One request per range with its pages in order; `more` are columns of `ranges` that it holds too."""
    p = P.slice_pages(pages, ranges.select("doc_id", *[c for c in keys if c != "doc_id"], "page_start", "page_end"))
    p = p.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("a"))
    p = p.join(ranges.select(*keys, *more), keys) if more else p
    body = F.struct(
        F.lit(kind).alias("kind"), F.concat_ws(":", *keys).alias("id"), F.lit("sliced").alias("mode"), *more, F.lit(config.max_output_tokens).alias("max_output_tokens"),
        F.transform("a", lambda x: x["text"]).alias("pages"),
    )
    return p.select(*keys, F.to_json(body).alias("request"))


LISTS = ("effective_dates", "glossary", "cross_references")


def _lists(parts: DataFrame) -> dict[str, DataFrame]:
    """(doc_id, list) of each of LISTS: the entries of all partial maps in batch order, without repeats."""
    order = ["batch", "pos"]
    each = {c: parts.select("doc_id", "batch", F.posexplode(f"o.{c}").alias("pos", c)) for c in LISTS}
    terms = O.merge_glossary(each["glossary"].select("doc_id", *order, "glossary.*"), order=order)
    merged = {
        "effective_dates": O.dedupe_strings(each["effective_dates"], "doc_id", "effective_dates", order),
        "glossary": terms.withColumn("glossary", F.struct("term", "definition")),
        "cross_references": O.sanitize_references(each["cross_references"], "doc_id", "cross_references", order),
    }
    return {c: m.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(*order, c))).getField(c).alias(c)) for c, m in merged.items()}


def analyze(pages: DataFrame, config: EngineConfig = EngineConfig(), client: Callable[[], Proposer] = RuleProposer) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(profiles, sections, usage) of the documents in `pages` (doc_id, page_no, text)."""
    # what has several consumers is written, so that no plan holds the steps before it more than once
    docs = materialize(pages.groupBy("doc_id").agg(F.max("page_no").alias("page_count")), "page-counts")
    batches = P.iter_batches(pages, docs, config.max_request_bytes, config.max_pages_per_batch, config.batch_overlap_pages)
    batches = batches.select("doc_id", "slice_start", (F.col("batch_no") * 1000 + F.col("slice_no")).alias("batch"), F.col("slice_start").alias("page_start"), F.col("slice_end").alias("page_end"))
    req = _limited(_request(pages, batches, "outline", ["doc_id", "batch", "slice_start"], [], config), config.outline_concurrency)
    called = call_rows(req, client, ("sections",), ["doc_id", "batch", "slice_start"], retries=config.max_transient_retries, repairs=config.max_repair_attempts)
    parts = materialize(called.withColumn("o", F.from_json("body", OUTLINE)).drop("body"), "outline")
    s = parts.select("doc_id", "batch", (F.col("slice_start") - 1).alias("off"), F.posexplode("o.sections").alias("pos", "s"))
    s = P.rebase(s.select("doc_id", F.struct("batch", "pos").alias("ord"), "off", "s.*"), "off").drop("off")
    from pyspark.sql import Window

    s = s.withColumn("ord", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")))
    merged = materialize(O.merge_sections(O.repair_ranges(s)).withColumn("section_id", F.col("ord")), "merged")
    settle(pages.sparkSession)
    grounded = materialize(G.ground_sections(merged, pages).drop("grounded", "section_id"), "grounded")
    sections = O.number_sections(O.fill_gaps(grounded, docs))
    meta = parts.select("doc_id", "batch", *[F.col(f"o.{c}").alias(c) for c in ("doc_type", "title", "plan_name", "sponsor", "notes")])
    first = O.first_nonempty(meta, "doc_id", "batch", ["doc_type", "title", "plan_name", "sponsor", "notes"], {"doc_type": "unknown"})
    lists = _lists(parts)
    for c in LISTS:
        first = first.join(lists[c], "doc_id", "left").withColumn(c, F.coalesce(c, F.array().cast(OUTLINE[c].dataType)))
    return docs.join(first, "doc_id", "left"), materialize(sections, "sections"), parts.select("model", *COUNTERS)


def _section_calls(pages: DataFrame, sections: DataFrame, profiles: DataFrame | None, config: EngineConfig, client: Callable[[], Proposer]) -> DataFrame:
    """The answers (doc_id, sec_no, off, body, ...) for all sections: whole documents where they fit a request, slices
    else; the context block comes with every request if there are profiles."""
    s = sections.select("doc_id", "sec_no", "page_start", "page_end")
    sizing = F.lit(f"Aim at {config.pack_target} tokens a chunk, {config.max_tokens} at most.")
    context = sizing
    if profiles is not None:
        terms = profiles.select("doc_id", F.posexplode("glossary").alias("term_ord", "g")).select("doc_id", "term_ord", "g.*")
        outline = sections.select("doc_id", F.col("sec_no").alias("section_id"), F.col("sec_no").alias("sec_ord"), "title", "section_type", "summary")
        c = context_blocks(profiles.select("doc_id", "title", "doc_type", "plan_name", "sponsor", "effective_dates"), outline, terms)
        s = s.join(c.withColumnRenamed("section_id", "sec_no"), ["doc_id", "sec_no"], "left")
        context = F.concat_ws("\n\n", "context", sizing)
    size = pages.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(T.encoded_size(F.octet_length("text"))).alias("b"))
    modes = size.select("doc_id", mode(F.col("n"), F.coalesce("b", F.lit(0)), config.max_request_bytes, config.full_document_pages).alias("mode"))
    s = materialize(s.withColumn("context", context).join(modes, "doc_id"), "section-calls")
    settle(pages.sparkSession)
    tries = {"retries": config.max_transient_retries, "repairs": config.max_repair_attempts}
    whole = s.where("mode = 'full'")
    lists = whole.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sec_no", F.col("page_start").alias("first"), F.col("page_end").alias("last"), "context"))).alias("sections"))
    docs = pages.join(modes.where("mode = 'full'"), "doc_id").groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda x: x["text"]).alias("pages"))
    full = call_sections(_limited(docs.join(lists, "doc_id"), config.chunk_concurrency), client, ("chunks",), settings={"max_output_tokens": config.max_output_tokens}, **tries)
    cut = s.where("mode = 'sliced'")
    req = _limited(_request(pages, cut, "chunks", ["doc_id", "sec_no"], ["context"], config), config.chunk_concurrency)
    sliced = call_rows(req, client, ("chunks",), ["doc_id", "sec_no"], **tries).join(cut.select("doc_id", "sec_no", (F.col("page_start") - 1).alias("off")), ["doc_id", "sec_no"])
    answers = full.unionByName(sliced)
    called = materialize(answers, "chunks")
    forget(answers, pages, sections)
    return called


def chunk(
    pages: DataFrame,
    sections: DataFrame,
    config: EngineConfig = EngineConfig(),
    client: Callable[[], Proposer] = RuleProposer,
    profiles: DataFrame | None = None,
    done: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(chunks, usage) of the given sections. `done` are the chunks of an interrupted run: those of the sections before
    the first without any are kept and numbered first, and only the other sections are called for."""
    kept, todo = None, sections
    if done is not None:
        done = done.where("section_title is not null")
        named = sections.select("doc_id", F.coalesce("title", F.lit("")).alias("title"), F.col("sec_no").alias("ord"))
        prefix = completed_prefix(named, done, "doc_id")
        kept = materialize(resume_plan(named, done, "doc_id"), "kept")
        todo = sections.join(prefix, "doc_id").where("sec_no >= done").drop("done")
    called = _section_calls(pages, todo, profiles, config, client)
    used = materialize(called.select("model", *COUNTERS), "usage")
    raw = called.withColumn("c", F.from_json("body", "chunks array<" + RAW_CHUNK.simpleString() + ">"))
    raw = raw.select("doc_id", "sec_no", "off", F.posexplode("c.chunks").alias("ord", "c")).select("doc_id", "sec_no", "off", "ord", "c.*").where("text is not null")
    sec = sections.select("doc_id", "sec_no", "section_type", F.col("page_start").alias("sec_start"), F.col("page_end").alias("sec_end"))
    raw = raw.join(sec, ["doc_id", "sec_no"])
    raw = C.normalize_chunk_pages(raw, "off", "sec_start", "sec_end")
    unlike = C.dedupe_raw_chunks(C.clean_raw_chunks(raw), ["doc_id", "sec_no"])
    forget(called, unlike)
    deduped = materialize(unlike.withColumn("chunk_id", F.struct("sec_no", "ord")), "deduped")
    forget(unlike)
    raw = G.ground_chunks(deduped, pages).drop("chunk_id")
    settle(pages.sparkSession)
    start: int | str = 0
    if kept is not None:
        n = kept.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("start_index"))
        raw, start = raw.join(n, "doc_id", "left").na.fill(0, ["start_index"]), "start_index"
    titles = sections.select("doc_id", "sec_no", F.col("title").alias("section_title"), "section_type", F.col("summary").alias("section_summary"))
    out = C.assemble_chunks(raw.drop("section_type"), "doc_id", "sec_no", "ord", config.max_tokens, config.target_tokens, start, counter=choose_counter(config.tokenizer_path), about=titles)
    forget(deduped, out, sections)
    out = out.drop("start_index")
    if kept is not None:
        have = titles.groupBy("doc_id", "section_title").agg(F.min("sec_no").alias("sec_no"))
        out = out.unionByName(kept.drop("sec_no").join(have, ["doc_id", "section_title"], "left"), allowMissingColumns=True)
    return out, used


def scores(pages: DataFrame, profiles: DataFrame, sections: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(documents, sections, flags, hints): coverage and novelty of documents and sections with their warnings, and the
    chunks and lines that aren't on their pages. Documents with too thin a text layer are 'skipped'."""
    gate = materialize(Q.scan_gate(pages), "gate")
    ok = gate.where("status = 'ok'").select("doc_id")
    read = pages.join(ok, "doc_id", "left_semi")
    documents = gate.join(Q.score(Q.bag(read, ["doc_id"]), Q.bag(chunks, ["doc_id"]), ["doc_id"], profiles), "doc_id", "left")
    shared = O.shared_pages(sections.join(ok, "doc_id", "left_semi")).select("doc_id", "sec_no", "title", "section_type", "page_start", "page_end", "shared")
    per = Q.score_sections(shared, chunks, read).join(shared.select("doc_id", "sec_no", "section_type", "shared"), ["doc_id", "sec_no"])
    unmapped = sections.where("section_type = 'unmapped'").select("doc_id", F.col("title").alias("section_title")).distinct()
    c = Q.scored_chunks(chunks.withColumn("chunk_id", F.col("chunk_index")), unmapped).join(ok, "doc_id", "left_semi")
    flags = Q.novelty_flags(c, read)
    hints = Q.locate_lines(Q.line_counts(c, ["doc_id", "chunk_id"]), Q.novel_lines(c, read), read)
    return documents, Q.warnings(per), flags.withColumnRenamed("chunk_id", "chunk_index"), hints.withColumnRenamed("chunk_id", "chunk_index")


def run(
    pages: DataFrame,
    config: EngineConfig = EngineConfig(),
    client: Callable[[], Proposer] = RuleProposer,
    resume: tuple[DataFrame, DataFrame, DataFrame] | None = None,
    fidelity: bool = True,
) -> RunResult:
    """Outline, chunks, usage and scores of every document. `resume` are the profiles, sections and chunks of an
    interrupted run: its maps are used again and its finished sections aren't called for."""
    if resume is None:
        profiles, sections, used = analyze(pages, config, client)
        profiles = materialize(profiles, "profiles")
        chunks, more = chunk(pages, sections, config, client, profiles)
        used = used.unionByName(more)
    else:
        profiles, sections, done = resume
        chunks, used = chunk(pages, sections, config, client, profiles, done)
    chunks = materialize(chunks, "chunks-out")
    maps = profiles.drop("sections").join(section_lists(sections), "doc_id", "left")
    if not fidelity:
        return RunResult(maps, sections, chunks, used)
    return RunResult(maps, sections, chunks, used, lambda: scores(pages, profiles, sections, chunks))


def section_lists(sections: DataFrame) -> DataFrame:
    """(doc_id, sections): each document's sections in order."""
    one = F.struct("title", "section_type", "summary", "page_start", "page_end").alias("s")
    return sections.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("sec_no", one))), lambda x: x["s"]).alias("sections"))


def resumed(profiles: DataFrame, chunks: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The state of an interrupted run from its written profiles and chunk lines."""
    s = profiles.select(key, F.posexplode("sections").alias("sec_no", "s")).select(key, "sec_no", "s.*")
    return profiles, s, chunks


def pages_of_text(docs: DataFrame, lines: int = 40) -> DataFrame:
    """(doc_id, page_no, text) of plain texts, `lines` lines a page."""
    t = docs.where("text is not null").select("doc_id", F.split("text", "\n").alias("a"))
    t = t.withColumn("page_no", F.explode(F.sequence(F.lit(1), F.ceil(F.size("a") / F.lit(lines)).cast("int"))))
    return t.select("doc_id", "page_no", F.array_join(F.slice("a", (F.col("page_no") - 1) * lines + 1, F.lit(lines)), "\n").alias("text"))


def context_blocks(profiles: DataFrame, sections: DataFrame, glossary: DataFrame) -> DataFrame:
    """(doc_id, section_id, context): the request context of every section."""
    from pagewright.operators.model_call import document_context

    outline = sections.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("sec_ord", F.coalesce("title", F.lit("")).alias("t")))), lambda x: x["t"]).alias("outline"))
    terms = glossary.groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("term_ord", F.coalesce("term", F.lit("")).alias("term"), F.coalesce("definition", F.lit("")).alias("definition")))), lambda x: x).alias("terms")
    )
    d = sections.join(profiles.withColumnsRenamed({"title": "doc_title"}), "doc_id").join(outline, "doc_id").join(terms, "doc_id", "left")
    fields = {"Title": F.col("doc_title"), "Type": F.col("doc_type"), "Plan": F.col("plan_name"), "Sponsor": F.col("sponsor"), "Effective dates": F.array_join("effective_dates", ", ")}
    empty = F.coalesce("terms", F.array().cast("array<struct<term_ord:int,term:string,definition:string>>"))
    text = document_context(fields, F.col("outline"), empty, T.clean(F.col("title")), T.clean(F.col("section_type")), F.col("summary"))
    return d.select("doc_id", "section_id", text.alias("context"))
