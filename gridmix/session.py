"""Spark session settings the engine relies on.

Everything in gridmix is UTC: hour-of-day, dates and hourly truncation are taken in UTC, so
``spark.sql.session.timeZone`` must be ``UTC``.  ``configure`` is idempotent and is called by
every public entry point, so callers may hand in any session.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings that change results or that every job needs; safe to set at runtime.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # silver Parquet written by pandas stores TIMESTAMP(NANOS); read it as INT64
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rewrite a (country, date) partition on re-run instead of the whole table
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a task lists many folders: by default each folder of a tree is a task, with a result of its own
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    On a cluster it points at shared storage and is used as is.  Only with a local master (tests), where
    one machine is all there is, a scratch folder is created and set with ``setCheckpointDir`` (the key itself is
    a core setting that cannot be changed at runtime).  Anywhere else a missing setting raises: executors
    would write to disks that the others don't see.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master or ""):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
        current = _LOCAL_FALLBACK.setdefault("dir", tempfile.mkdtemp(prefix="gridmix-ckpt-"))
    if sc is not None:
        sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    return current


def _hadoop_path(spark: SparkSession, path: str):
    """(file system, path) by Hadoop's API, which knows every store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop_path(spark, path)
    return fs.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Paths right below a folder; none where it doesn't exist."""
    fs, at = _hadoop_path(spark, path)
    return [str(f.getPath().toString()) for f in fs.listStatus(at)] if fs.exists(at) else []


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob."""
    fs, at = _hadoop_path(spark, pattern)
    return [str(f.getPath().toString()) for f in fs.globStatus(at) or []]


def first_and_last(spark: SparkSession, pattern: str) -> list[str]:
    """The first and the last path by name that match a glob, the same one if there is one, none if there is none.
    Hadoop sorts matches by name."""
    fs, at = _hadoop_path(spark, pattern)
    found = fs.globStatus(at)
    if not found:
        return []
    return [str(found[i].getPath().toString()) for i in (0, len(found) - 1)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one piece."""
    fs, at = _hadoop_path(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _hadoop_path(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, at = _hadoop_path(spark, path)
    fs.delete(at, True)


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Folders that ``work_dir`` names inside are removed at the end: for runs whose results are elsewhere by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            delete(spark, path)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/gridmix-{name}-{uuid.uuid4().hex[:12]}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


def materialize(df, name: str = "model"):
    """Cut lineage for a model that several consumers read: write it once as Parquet into the
    shared checkpoint folder and read it back.  One computation (an RDD checkpoint would
    compute the plan a second time to write it), columnar files, and readers still get column
    pruning and filter pushdown.  Written files survive executor loss."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *calls):
    """Results of calls that run jobs of their own and don't need each other's: their jobs share the cluster, so short ones don't
    wait for one another's start and end.  The first error is raised when all are done."""
    with ThreadPoolExecutor(max_workers=len(calls)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]


def get_spark(master: str | None = None, app: str = "gridmix", shuffle_partitions: int | None = None,
              driver_memory: str = "8g") -> SparkSession:
    """Build (or reuse) a session for tests, bench and local runs."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
