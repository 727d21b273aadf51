"""Session for local use, and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def local_session(cpus: int | str = "*", name: str = "tallyfold") -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        # types of a batch run side by side, each in a pool
        .config("spark.scheduler.mode", "FAIR")
        # partitioned writes keep a writer per folder open instead of sorting first
        .config("spark.sql.maxConcurrentOutputFileWriters", "64")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by spark.checkpoint.dir."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _LOCAL_ROOT:
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(root)
        _LOCAL_ROOT[sc.applicationId] = root
    return _LOCAL_ROOT[sc.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared root; Spark creates it on write."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/{app}/{name}-{uuid.uuid4().hex[:12]}"


_SCOPES = threading.local()


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Delete the tables that materialise() stores inside, at the end; those taken off the list stay.

    For work whose result is written elsewhere by then.
    """
    stack = _SCOPES.__dict__.setdefault("stack", [])
    stack.append([])
    try:
        yield stack[-1]
    finally:
        discard(*stack.pop())


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and read it back.

    The lineage ends at the files, so a lost executor costs a re-read and not
    a recomputation, several consumers share one evaluation, and Catalyst knows
    the true size when it picks join strategies.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    if _SCOPES.__dict__.get("stack"):
        _SCOPES.stack[-1].append(stored)
    return stored


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that materialise() returned, once nothing reads them any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
