"""Calls of a proposing model as row sources.

A proposer turns a request (a JSON object with the pages or section to work on) into a JSON object.
Calls run inside tasks, one per row, and carry the order columns of their rows, so results don't
depend on the order in which calls end. Transient failures are retried with doubling waits, answers
that don't parse are repaired once, refusals are never retried. Offline proposers (rules, replay) are
deterministic; a network client only has to implement `propose`.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTERS = ("input_tokens", "output_tokens", "cache_creation_input_tokens", "cache_read_input_tokens")


class Transient(Exception):
    """Worth another try."""


class Refused(Exception):
    """Never worth another try."""


class Overflow(Exception):
    """The request is larger than the model takes."""


class Unusable(Exception):
    """The answer doesn't hold what was asked for."""


@dataclass
class Answer:
    body: str
    model: str = ""
    usage: dict = field(default_factory=dict)


class Proposer(Protocol):
    def propose(self, request: dict, repair: str | None = None) -> Answer: ...


@dataclass
class RuleProposer:
    """Offline stand-in: lines in capitals or with a numbered heading open sections, blank lines split chunks."""

    name: str = "offline-rules"

    def propose(self, request: dict, repair: str | None = None) -> Answer:
        pages, at = request.get("pages") or [], 1
        n = sum(len(p) for p in pages)
        if request.get("mode") == "full":
            at = request["first"]
            pages = pages[at - 1 : request["last"]]
        if request.get("kind") == "outline":
            found, last = [], 1
            for no, text in enumerate(pages, 1):
                for line in text.split("\n"):
                    s = line.strip()
                    if 3 < len(s) < 80 and (s.isupper() or re.match(r"(?:article|section|part)\s+\d+", s, re.I)):
                        found.append({"title": s, "section_type": "unknown", "summary": "", "page_start": no, "page_end": no})
                last = no
            for a, b in zip(found, found[1:], strict=False):
                a["page_end"] = max(a["page_start"], b["page_start"])
            if found:
                found[-1]["page_end"] = max(last, found[-1]["page_start"])
            body = {"doc_type": "unknown", "title": next((p.strip().split("\n")[0] for p in pages if p.strip()), ""), "plan_name": "", "sponsor": "",
                    "effective_dates": [], "sections": found, "glossary": [], "cross_references": [], "notes": ""}
        else:
            body = {"chunks": [{"text": t.strip(), "keywords": [], "cross_references": [], "page_start": no, "page_end": no}
                               for no, p in enumerate(pages, at) for t in re.split(r"\n\s*\n", p) if t.strip()]}
        return Answer(json.dumps(body, ensure_ascii=False), self.name, {"input_tokens": n, "output_tokens": len(json.dumps(body))})


@dataclass
class ReplayProposer:
    """Recorded answers by request id; an exception entry is raised."""

    recorded: dict[str, list]
    seen: dict[str, int] = field(default_factory=dict)

    def propose(self, request: dict, repair: str | None = None) -> Answer:
        key = str(request.get("id"))
        at = self.seen.get(key, 0)
        self.seen[key] = at + 1
        entry = self.recorded[key][min(at, len(self.recorded[key]) - 1)]
        if isinstance(entry, Exception):
            raise entry
        return entry if isinstance(entry, Answer) else Answer(entry if isinstance(entry, str) else json.dumps(entry), "replay", {})


def structured_call(client: Proposer, request: dict, required: tuple[str, ...], retries: int = 2, repairs: int = 1, wait: Callable[[float], None] = time.sleep) -> tuple[dict, list[Answer]]:
    """The parsed answer and every answer received (each is billed)."""
    answers: list[Answer] = []
    repair, tries, pause = None, 0, 2.0
    while True:
        try:
            answers.append(client.propose(request, repair))
        except Transient:
            if tries >= retries:
                raise
            tries += 1
            wait(pause)
            pause *= 2
            continue
        try:
            body = json.loads(answers[-1].body)
            if not isinstance(body, dict) or (missing := [k for k in required if k not in body]):
                raise ValueError(f"fields are missing: {missing if isinstance(body, dict) else required}")
            return body, answers
        except ValueError as e:
            if repairs <= 0:
                raise Unusable(str(e)) from e
            repairs -= 1
            repair = str(e)


def call_rows(requests: DataFrame, client: Callable[[], Proposer], required: tuple[str, ...], keep: list[str], request: str = "request", retries: int = 2, repairs: int = 1) -> DataFrame:
    """`keep` columns, body (JSON or null), error, model and usage counters (null where not reported) of one
    call per row. The client is made once per task."""
    src = requests.select(*keep, F.col(request).alias("__r"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    schema += ", body string, error string, model string, " + ", ".join(f"{c} bigint" for c in COUNTERS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        for b in batches:
            rows = []
            for r in b["__r"]:
                body, error, answers = None, None, []
                try:
                    got, answers = structured_call(own, json.loads(r), required, retries, repairs)
                    body = json.dumps(got, ensure_ascii=False)
                except (Transient, Refused, Unusable, Overflow) as e:
                    error = f"{type(e).__name__}: {e}"
                rows.append((body, error, answers[-1].model if answers else None, *_used(answers)))
            out = pd.DataFrame(rows, columns=["body", "error", "model", *COUNTERS], index=b.index).astype({c: "Int64" for c in COUNTERS})
            yield pd.concat([b[keep], out], axis=1)

    return src.mapInPandas(run, schema)


def _used(answers: list[Answer]) -> list[int | None]:
    return [sum(v) if (v := [a.usage[c] for a in answers if a.usage.get(c) is not None]) else None for c in COUNTERS]


#: Answers and characters of answers that leave a task at once.
ANSWERS, ANSWER_CHARS = 1000, 4_000_000
SECTION_CALL = "sec_no int, first int, last int, context string"


def call_sections(documents: DataFrame, client: Callable[[], Proposer], required: tuple[str, ...], key: str = "doc_id", settings: dict | None = None, retries: int = 2, repairs: int = 1) -> DataFrame:
    """One call per section with the whole document in the request: (key, sec_no, off, body, error, model and counters).

    `documents`: key, pages array<string>, sections array<struct<SECTION_CALL>>. A document's calls run one after the
    other, so that its text is held once and the first call warms a prompt cache. If a request overflows, the
    document goes on in sliced mode, each section with its own pages; `off` is what to add to an answer's pages."""
    src = documents.select(key, "pages", F.to_json("sections").alias("__s"))
    schema = f"`{key}` {src.schema[key].dataType.simpleString()}, sec_no int, off int, body string, error string, model string, " + ", ".join(f"{c} bigint" for c in COUNTERS)
    columns = [key, "sec_no", "off", "body", "error", "model", *COUNTERS]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in COUNTERS})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        rows, chars = [], 0
        for b in batches:
            for name, pages, sections in zip(b[key], b["pages"], b["__s"], strict=True):
                full, pages = True, list(pages)
                for s in json.loads(sections):
                    body, error, answers = None, None, []
                    while True:
                        shown = pages if full else pages[s["first"] - 1 : s["last"]]
                        request = {"kind": "chunks", "id": f"{name}:{s['sec_no']}", "mode": "full" if full else "sliced", "first": s["first"], "last": s["last"], "context": s.get("context"), "pages": shown} | (settings or {})
                        try:
                            got, answers = structured_call(own, request, required, retries, repairs)
                            body = json.dumps(got, ensure_ascii=False)
                        except Overflow as e:
                            if full:
                                full = False
                                continue
                            error = f"{type(e).__name__}: {e}"
                        except (Transient, Refused, Unusable) as e:
                            error = f"{type(e).__name__}: {e}"
                        break
                    rows.append((name, s["sec_no"], 0 if full else s["first"] - 1, body, error, answers[-1].model if answers else None, *_used(answers)))
                    chars += len(body or "")
                    if len(rows) >= ANSWERS or chars >= ANSWER_CHARS:
                        yield frame(rows)
                        rows, chars = [], 0
        if rows:
            yield frame(rows)

    return src.mapInPandas(run, schema)


def mode(pages: Column, encoded_bytes: Column, budget: int, most_pages: int = 100) -> Column:
    """'full' where the whole document fits one request, else 'sliced'."""
    return F.when((pages <= most_pages) & (encoded_bytes <= budget), "full").otherwise("sliced")


class Embedder(Protocol):
    """Texts to vectors of one length; the pluggable point of `embed_rows`."""

    def embed(self, texts: list[str]) -> list[list[float]]: ...


@dataclass
class RateLimited(Exception):
    """HTTP 429 or 5xx; `retry_after` are the seconds the service asks for."""

    retry_after: float | None = None


def embed_texts(client: Embedder, texts: list[str], dim: int, batch: int = 64, retries: int = 4, wait: Callable[[float], None] = time.sleep) -> list[list[float]]:
    """Vectors of the texts in sub-batches. Limits and server faults are tried again, after the time the service asks
    for or doubling pauses; a wrong number or length of vectors is an error."""
    out: list[list[float]] = []
    for at in range(0, len(texts), batch):
        part, pause = texts[at : at + batch], 1.0
        for left in range(retries, -1, -1):
            try:
                got = client.embed(part)
                break
            except RateLimited as e:
                if not left:
                    raise
                wait(e.retry_after if e.retry_after is not None else pause)
                pause *= 2
        if len(got) != len(part) or any(len(v) != dim for v in got):
            raise ValueError(f"the embedder must give one vector of length {dim} per text")
        out += got
    return out


def embed_rows(rows: DataFrame, client: Callable[[], Embedder], dim: int, text: str = "embedding_text", key: str = "id", embedding: str = "embedding", batch: int = 64, retries: int = 4) -> DataFrame:
    """The next version of `rows`: those without a vector get one, the others keep theirs. Only the rows without one
    go through Python, and only vectors are joined back."""
    todo = rows.where(F.col(embedding).isNull() & F.col(text).isNotNull()).select(key, F.col(text).alias("__t"))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = client()
        for b in batches:
            yield b[[key]].assign(__v=embed_texts(own, b["__t"].tolist(), dim, batch, retries))

    new = todo.mapInPandas(run, f"`{key}` {kind}, __v array<float>")
    d = rows.join(new, key, "left").withColumn(embedding, F.coalesce(embedding, "__v"))
    return d.select(*rows.columns)


def usage_summary(totals: DataFrame, cost: float | None = None) -> str:
    """One line per model of `usage_totals` (a row per model, so few) and the cost, if all prices are known."""
    lines = []
    for r in totals.orderBy("model").collect():
        shown = ", ".join(f"{(r[c] or 0):,} {c.replace('_', ' ')}" for c in COUNTERS if c in totals.columns)
        lines.append(f"{r['model'] or 'unknown model'}: {r['calls']:,} calls, {shown}")
    lines.append(f"cost: {cost:,.2f}" if cost is not None else "cost: unknown")
    return "\n".join(lines)


@dataclass
class HashEmbedder:
    """Deterministic offline embedder: signed hashes of the words, unit length."""

    dim: int = 1024

    def embed(self, texts: list[str]) -> list[list[float]]:
        import numpy as np
        import xxhash

        out = []
        for t in texts:
            v = np.zeros(self.dim, np.float32)
            for w in re.findall(r"\w+", (t or "").lower()):
                h = xxhash.xxh64_intdigest(w)
                v[h % self.dim] += 1 if h >> 63 else -1
            n = np.linalg.norm(v)
            out.append((v / n if n else v).tolist())
        return out


def hash_embedder(dim: int = 1024, batch: int = 64):
    """Deterministic offline embedding as a pandas UDF: signed hashes of the words, unit length. Texts go
    through in sub-batches as a client's requests would."""

    @F.pandas_udf("array<float>")
    def embed(texts: pd.Series) -> pd.Series:
        return pd.Series(embed_texts(HashEmbedder(dim), texts.tolist(), dim, batch), dtype=object)

    return embed


#: Lines of the context block (fixed values); its labels, here and in `plans.pipeline`, are fixed as well.
CONTEXT_HEAD, CONTEXT_SECTION = "DOCUMENT MAP (for context):", "CURRENT SECTION:"


def document_context(profile: dict[str, Column], outline: Column, terms: Column, title: Column, kind: Column, summary: Column, most_terms: int = 40) -> Column:
    """The context block of a section's request. `outline` is the array of titles, `terms` an array of
    struct(term, definition); blank fields are left out."""

    def line(label: str, v: Column) -> Column:
        return F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"- {label}: "), v))

    shown = F.array_join(F.transform(F.slice(terms, 1, most_terms), lambda t: F.concat(t["term"], F.lit(": "), t["definition"])), "; ")
    return F.concat_ws(
        "\n",
        F.lit(CONTEXT_HEAD),
        *[line(k, v) for k, v in profile.items()],
        line("Section outline", F.array_join(outline, "; ")),
        line("Defined terms", shown),
        F.lit(""),
        F.lit(CONTEXT_SECTION),
        F.concat(F.lit("- Title: "), title),
        F.concat(F.lit("- Type: "), kind),
        line("Summary", summary),
    )
