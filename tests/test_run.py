"""Model calls, the pipeline, sources, sinks, streaming, jobs and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from pagewright.operators import model_call as M
from pagewright.plans import pipeline
from pagewright.schemas import CHUNK
from pagewright.sources import readers, writers
from pagewright.streaming import incremental as I


def test_transient_failures_are_retried_and_answers_repaired():
    waits = []
    c = M.ReplayProposer({"1": [M.Transient("busy"), "not json", {"sections": []}]})
    body, answers = M.structured_call(c, {"id": "1"}, ("sections",), wait=waits.append)
    assert body == {"sections": []} and waits == [2.0] and len(answers) == 2
    with pytest.raises(M.Refused):
        M.structured_call(M.ReplayProposer({"1": [M.Refused("no")]}), {"id": "1"}, (), wait=waits.append)
    with pytest.raises(M.Unusable):
        M.structured_call(M.ReplayProposer({"1": ["x"]}), {"id": "1"}, (), wait=waits.append)


def test_pipeline_covers_the_source(spark):
    parts = [[f"SECTION {i} RULES", f"Members of group {i} may join the plan on day {i} of work.", "", f"SECTION {i} CLAIMS", f"Send claim {i} to the office."] for i in range(3)]
    text = "\n".join(line for p in parts for line in p)
    pages = pipeline.pages_of_text(spark.createDataFrame([(1, text), (2, None), (3, "short")], "doc_id int, text string"), 5)
    r = pipeline.run(pages)
    f = {x.doc_id: x for x in r.fidelity.collect()}
    assert f[1].status == "ok" and f[1].coverage == 1.0 and f[3].status == "skipped"
    assert [x.chunk_index for x in r.chunks.where("doc_id = 1").orderBy("chunk_index").collect()] == list(range(r.chunks.where("doc_id = 1").count()))


def recording(overflow=False):
    """The rule proposer; shows its request in the keywords, and overflows on whole documents if told to."""

    class Recording:
        def propose(self, request, repair=None):
            if overflow and request.get("mode") == "full":
                raise M.Overflow("too long")
            body = M.RuleProposer().propose(request)
            parsed = json.loads(body.body)
            for c in parsed.get("chunks", []):
                c["keywords"] = [request["mode"], f"context {'CURRENT SECTION' in request['context']}", f"sizing {'tokens a chunk' in request['context']}"]
            return M.Answer(json.dumps(parsed), "rules", body.usage)

    return Recording


def test_modes_context_and_downgrade(spark):
    from pagewright.config import EngineConfig

    pages = spark.createDataFrame([(1, n, f"SECTION {n} RULES\nMembers of group {n} may join.") for n in range(1, 4)], "doc_id int, page_no int, text string")
    want = None
    for config, client, shown in (
        (EngineConfig(), recording(), "full"),
        (EngineConfig(full_document_pages=2), recording(), "sliced"),
        (EngineConfig(), recording(True), "sliced"),
    ):
        profiles, sections, _ = pipeline.analyze(pages, config)
        c, used = pipeline.chunk(pages, sections, config, client, profiles)
        got = c.collect()
        rows = sorted((r.chunk_index, r.text, r.page_start, r.page_end) for r in got)
        assert {tuple(r.keywords) for r in got} == {(shown, "context True", "sizing True")}
        assert want in (None, rows) and used.count() == sections.count()
        want = rows


def test_interrupted_runs_go_on(spark):
    pages = spark.createDataFrame([(d, n, f"SECTION {n} RULES\nMembers of group {n} of {d} may join the plan.") for d in (1, 2) for n in range(1, 5)], "doc_id int, page_no int, text string")
    r = pipeline.run(pages)
    whole = sorted((x.doc_id, x.chunk_index, x.section_title, x.text) for x in r.chunks.collect())
    titles = {x.sec_no: x.title for x in r.sections.where("doc_id = 1").collect()}
    kept = r.chunks.where((F.col("doc_id") == 1) & (F.col("section_title") != titles[2]))  # the last section's chunks are stale
    again = pipeline.run(pages, resume=(r.profiles, r.sections, kept))
    assert sorted((x.doc_id, x.chunk_index, x.section_title, x.text) for x in again.chunks.collect()) == whole
    assert again.usage.count() == 4 + 2
    assert again.section_scores.count() == r.sections.count() and again.flags.count() == again.hints.count() == 0
    assert {x.status for x in again.fidelity.collect()} <= {"ok", "skipped"}


def test_lists_of_all_partial_maps_reach_the_profiles(spark, tmp_path):
    from pagewright.config import EngineConfig

    class Terms:
        """Answers each outline request with a term, a reference and a date of its first page and ones of all."""

        name = "terms"

        def propose(self, request, repair=None):
            first = request["pages"][0]
            maps = {"d1": {"glossary": [{"term": f"T {first}", "definition": "x"}, {"term": "All ", "definition": first}], "cross_references": ["; See 1", f"See {first}"], "effective_dates": ["2020", f"in {first}", " "]}}
            return M.Answer(json.dumps({"sections": []} | maps.get(request["id"].split(":")[0], {})), self.name, {"input_tokens": 1, "output_tokens": 1})

    pages = spark.createDataFrame([(d, n, f"page{n}") for d in ("d1", "d2") for n in range(1, 4)], "doc_id string, page_no int, text string")
    profiles, _, _ = pipeline.analyze(pages, EngineConfig(max_pages_per_batch=2, batch_overlap_pages=1), Terms)
    p = {r.doc_id: r for r in profiles.collect()}
    assert [(t.term.strip(), t.definition) for t in p["d1"].glossary] == [("T page1", "x"), ("All", "page1"), ("T page2", "x")]
    assert p["d1"].cross_references == ["See 1", "See page1", "See page2"] and p["d1"].effective_dates == ["2020", "in page1", "in page2"]
    assert p["d2"].glossary == p["d2"].cross_references == p["d2"].effective_dates == []
    writers.write_profiles(profiles.withColumnRenamed("doc_id", "source_file"), str(tmp_path / "p"))
    assert {r.source_file: len(r.glossary) for r in readers.read_profiles(spark, str(tmp_path / "p")).collect()}["d1"] == 3


def test_chunk_lines_round_trip(spark, tmp_path):
    p = tmp_path / "c"
    p.mkdir()
    (p / "a.jsonl").write_text('{"text": "x", "extra": 1}\n\n{"source_file": "no text"}\n{"text": "y", "keywords": ["k"]}\n')
    c = readers.read_chunks(spark, str(p))
    assert sorted((r.text, r.section_type, list(r.keywords)) for r in c.collect()) == [("x", "unknown", []), ("y", "unknown", ["k"])]
    assert readers.read_raw_chunks(spark, str(p)).selectExpr("variant_get(line, '$.extra', 'int') e").where("e = 1").count() == 1
    writers.write_chunks(c, str(tmp_path / "o"))
    assert readers.read_chunks(spark, str(tmp_path / "o")).count() == 2


def test_review_page_escapes(spark):
    c = spark.createDataFrame([(0, "</script><!-- x", "S", 1, 1, 2, [])], "chunk_index int, text string, section_title string, page_start int, page_end int, token_count int, keywords array<string>")
    page = writers.review_page({"title": "t"}, c)
    assert "</script><!--" not in page and "<\\/script><\\!-- x" in page


def test_stream_emits_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"text": "x"}\n{"text": "y"}\n')
    for _ in range(2):  # the second pass has nothing new
        q = I.emit(I.watch(spark, str(tmp_path / "in"), CHUNK), lambda d: d.select("text"), str(tmp_path / "out"), str(tmp_path / "cp"))
        q.awaitTermination()
    assert sorted(r.text for r in I.emitted(spark, str(tmp_path / "out")).collect()) == ["x", "y"]


def test_one_job_at_a_time(spark, tmp_path):
    m = I.JobManager(str(tmp_path))
    j = m.create("a.pdf")
    with pytest.raises(I.Busy):
        m.create("b.pdf")
    m.run(j, lambda progress: progress("chunk", 1, 2))
    bad = m.run(m.create("b.pdf"), lambda progress: 1 / 0)
    assert m.get(j.job_id).state == "done" and bad.state == "error" and "ZeroDivision" in bad.error
    assert m.path("../etc", "job.json") is None and m.path(j.job_id, "x") is None
    assert m.frame(spark).count() == 2


def test_command_line(spark, tmp_path):
    from pagewright.cli import main

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("RULES OF THE PLAN\nMembers join at work.\fCLAIMS TO FILE\nSend claims.")
    (tmp_path / "d" / "b.txt").write_text("RULES OF THE FUND\nMembers pay at work.\fHOW TO APPEAL\nSend a letter.")
    assert main(["chunk", str(tmp_path / "d"), "--plain", "--out", str(tmp_path / "o")]) == 0
    chunks = readers.read_chunks(spark, str(tmp_path / "o/chunks"))
    before = [(r.source_file, r.chunk_index, r.text) for r in chunks.collect()]
    assert len(before) >= 2
    assert main(["view", str(tmp_path / "o/chunks"), "--out", str(tmp_path / "v.html")]) == 0
    assert main(["analyze", str(tmp_path / "d"), "--plain", "--out", str(tmp_path / "p")]) == 0
    assert {r.source_file for r in readers.read_chunks(spark, str(tmp_path / "o/chunks")).collect()} == {"a.txt", "b.txt"}
    assert all(len(r.sections) > 0 for r in readers.read_profiles(spark, str(tmp_path / "o/profiles")).collect())
    assert main(["chunk", str(tmp_path / "d"), "--plain", "--out", str(tmp_path / "o"), "--resume", "--no-fidelity"]) == 0
    assert sorted((r.source_file, r.chunk_index, r.text) for r in readers.read_chunks(spark, str(tmp_path / "o/chunks")).collect()) == sorted((r[0], r[1], r[2]) for r in before)
    assert main(["fidelity", str(tmp_path / "d"), "--plain", "--chunks", str(tmp_path / "o/chunks"), "--profiles", str(tmp_path / "o/profiles"), "--out", str(tmp_path / "f")]) == 0
    assert main(["serve", str(tmp_path / "d"), "--plain", "--out", str(tmp_path / "s"), "--checkpoint", str(tmp_path / "sc"), "--once"]) == 0
    assert I.emitted(spark, str(tmp_path / "s")).count() == len(before)
    assert main(["export", "--profiles", str(tmp_path / "p/profiles"), "--chunks", str(tmp_path / "o/chunks"), "--out", str(tmp_path / "x")]) == 0
    assert spark.read.parquet(str(tmp_path / "x/chunks")).count() == len(before)
    assert spark.read.parquet(str(tmp_path / "x/documents")).count() == 2


def test_run_has_small_plans_and_few_tables(spark, monkeypatch):
    """The driver's memory follows the plans; before, one held 28 exchanges and the scores were prepared unasked. Tables that
    were read to their end are deleted, not kept to the end of the run."""
    import os

    from pagewright import session
    from pagewright.operators import chunks, fidelity, grounding, intervals

    plans, write = {}, session.materialize

    def seen(df, label="stage"):
        plans[label] = df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
        return write(df, label)

    for m in (pipeline, chunks, fidelity, grounding, intervals):
        monkeypatch.setattr(m, "materialize", seen)
    had = set(session._SCRATCH)
    pages = spark.createDataFrame([(d, n, f"SECTION {n} RULES\nMembers of group {n} of {d} may join the plan.") for d in (1, 2) for n in range(1, 5)], "doc_id int, page_no int, text string")
    r = pipeline.run(pages)
    assert max(plans.values()) <= 18, plans
    assert "chunk-words" not in plans and "gate" not in plans
    kept = {os.path.basename(p).rpartition("-")[0] for p in set(session._SCRATCH) - had}
    assert not kept & {"section-calls", "chunks", "raw-chunks", "deduped"}
    assert r.flags.count() == 0 and "chunk-words" in plans and {x.status for x in r.fidelity.collect()} <= {"ok", "skipped"}
    assert r.usage.count() == 8 + 2 and r.chunks.count() == 8


def test_answers_of_many_documents_leave_together(spark, monkeypatch):
    monkeypatch.setattr(M, "ANSWERS", 7)
    rows = [(i, [f"page {i}", "x"], [(0, 1, 1, None), (1, 2, 2, None)] if i % 3 else [(0, 1, 2, None)]) for i in range(40)]
    d = spark.createDataFrame(rows, f"doc_id int, pages array<string>, sections array<struct<{M.SECTION_CALL.replace(' int', ':int').replace(' string', ':string')}>>").coalesce(1)
    got = M.call_sections(d, M.RuleProposer, ("chunks",)).collect()
    assert sorted((r.doc_id, r.sec_no) for r in got) == sorted((i, s[0]) for i, _, ss in rows for s in ss)
    assert all(json.loads(r.body)["chunks"][0]["text"] == (f"page {r.doc_id}" if r.sec_no == 0 else "x") for r in got)
