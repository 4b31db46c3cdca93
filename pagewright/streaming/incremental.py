"""Incremental runs: a drop folder as a stream, idempotent batches, progress and one job at a time."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType


def watch(spark: SparkSession, folder: str, schema: StructType, most_files: int = 100) -> DataFrame:
    """JSON lines of the files that arrive in `folder`."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).json(folder)


def watch_documents(spark: SparkSession, folder: str, most_files: int = 100) -> DataFrame:
    """(source_file, n_bytes, content) of the documents that arrive in `folder`."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    d = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", most_files).load(folder)
    return d.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), F.col("length").alias("n_bytes"), "content")


def emit(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Write `transform` of every batch to its own partition of `out`. A batch that runs again after a
    failure replaces its partition, so results are exactly once."""

    def write(df: DataFrame, batch: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="2 seconds")).start()


def emitted(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*")


@dataclass
class Progress(StreamingQueryListener):
    """Calls `on_progress(phase, done, total)` after every batch; a phase that is skipped reports (1, 1)."""

    on_progress: Callable[[str, int, int], None]
    done: int = 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.on_progress("started", 0, 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.done += event.progress.numInputRows
        self.on_progress("batch", event.progress.batchId + 1, self.done)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.on_progress("done", self.done, self.done)


@dataclass
class Job:
    source: str
    job_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    state: str = "queued"
    created_at: float = field(default_factory=time.time)
    finished_at: float | None = None
    phase: str = ""
    done: int = 0
    total: int = 0
    error: str | None = None


class Busy(RuntimeError):
    """Another job is active."""


class JobManager:
    """One active job; every change is journaled as a JSON file, so a restart finds its jobs."""

    ACTIVE = ("uploading", "queued", "running")
    FILES = ("job.json", "profile.json", "chunks.jsonl", "curated.jsonl")

    def __init__(self, root: str):
        self.root = Path(root)
        self.root.mkdir(parents=True, exist_ok=True)

    def _save(self, job: Job) -> Job:
        d = self.root / job.job_id
        d.mkdir(exist_ok=True)
        (d / "job.json.new").write_text(json.dumps(asdict(job)))
        (d / "job.json.new").replace(d / "job.json")
        return job

    def list(self) -> list[Job]:
        jobs = [Job(**json.loads(p.read_text())) for p in self.root.glob("*/job.json")]
        return sorted(jobs, key=lambda j: (-j.created_at, j.job_id))

    def get(self, job_id: str) -> Job | None:
        p = self.path(job_id, "job.json")
        return Job(**json.loads(p.read_text())) if p and p.exists() else None

    def path(self, job_id: str, name: str) -> Path | None:
        """The file of a job; null for ids that aren't 12 hex digits and files that aren't listed."""
        ok = len(job_id) == 12 and all(c in "0123456789abcdef" for c in job_id) and name in self.FILES
        return self.root / job_id / name if ok else None

    def create(self, source: str) -> Job:
        if any(j.state in self.ACTIVE for j in self.list()):
            raise Busy("another job is active")
        return self._save(Job(source))

    def run(self, job: Job, work: Callable[[Callable[[str, int, int], None]], None]) -> Job:
        def progress(phase: str, done: int, total: int) -> None:
            job.phase, job.done, job.total = phase, done, total
            self._save(job)

        job.state = "running"
        self._save(job)
        try:
            work(progress)
            job.state = "done"
        except Exception as e:  # noqa: BLE001 - the journal holds what went wrong
            job.state, job.error = "error", f"{type(e).__name__}: {e}"
        job.finished_at = time.time()
        return self._save(job)

    def frame(self, spark: SparkSession) -> DataFrame:
        """The journal as a table."""
        return spark.read.schema("source string, job_id string, state string, created_at double, finished_at double, phase string, done int, total int, error string").json(
            f"{self.root}/*/job.json"
        ).orderBy(F.desc("created_at"), "job_id")
