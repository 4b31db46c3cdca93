"""Session helpers: table access, shared scratch tables, lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: list[str] = []


def build_session(app: str = "pagewright", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the engine expects (UTC, AQE with skew handling)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for k, v in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer partitions than the session has cores (few or unsplittable files) is dealt out to
    all of them before costly work on its rows; larger scans stay as they are, without a shuffle. Takes
    plain scans only: the partitions of a plan with exchanges aren't known before it runs."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    parts = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return scan.repartition(cores) if parts < cores else scan


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where it is set, else a
    temporary folder of this machine (local mode and tests only)."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = os.path.join(tempfile.gettempdir(), "pagewright-scratch")
    return path.rstrip("/")


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    It cuts the lineage (a lost executor costs a read, not a recomputation), keeps the
    columnar layout, and makes a costly projection run once for several consumers."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/pagewright/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _SCRATCH.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished plans: it does so once the driver has collected their
    garbage, which in a run of many plans may come after the disk is full."""
    spark.sparkContext._jvm.System.gc()


def forget(done: DataFrame, *but: DataFrame) -> int:
    """Delete the scratch tables that `done` reads and none of `but` does, in the middle of a long run."""
    read = lambda df: {p for p in _SCRATCH for f in df.inputFiles() if f"/{os.path.basename(p)}/" in f}
    gone = read(done).difference(*map(read, but))
    n = _delete(done.sparkSession, gone)
    settle(done.sparkSession)
    return n


def _delete(spark: SparkSession, paths: set[str]) -> int:
    n = 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        _SCRATCH.remove(path)
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n


def release(spark: SparkSession) -> int:
    """Delete the scratch tables this process wrote; results read from them end with that."""
    return _delete(spark, set(_SCRATCH))
