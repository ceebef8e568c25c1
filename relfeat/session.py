"""Session settings and the shared folder used for durable intermediate results."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # feature blocks are wide: keep them inside generated code
    "spark.sql.codegen.maxFields": "400",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # no Python stack capture per column call
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "relfeat", **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_dir_lock = threading.Lock()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A local master without that setting gets a temporary folder; a cluster without it is an error,
    because executors cannot see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    with _dir_lock:
        configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
        if configured is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="relfeat-checkpoint-")
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a checkpoint that survives executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into a table of the shared folder and read that: one pass over the last stage where a checkpoint
    takes two, and the planner learns the true size. ``released`` and ``clear_stored`` delete these tables."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    owned(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_stored: list[str] = []
_scope = threading.local()


def owned(path: str) -> None:
    """A stored table belongs to the innermost ``released`` of the thread, or else to the process."""
    getattr(_scope, "paths", _stored).append(path)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    done = 0
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        done += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return done


def clear_stored(spark: SparkSession) -> int:
    """Delete the tables written by ``stored`` in this process; results that still read them are lost with them."""
    return _delete(spark, _stored)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread stores inside are deleted at the end: what is to last is stored after it."""
    outer = getattr(_scope, "paths", _stored)
    _scope.paths = []
    try:
        yield
    finally:
        inner, _scope.paths = _scope.paths, outer
        _delete(spark, inner)


# Spark's own setting: a query that ended deletes its shuffle files
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing = {"lock": threading.Lock(), "depth": 0, "before": None}


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside delete their shuffle files, which else stay until the driver happens to collect its garbage.
    A plan that needs such files again computes them again."""
    with _freeing["lock"]:
        if not _freeing["depth"]:
            _freeing["before"] = spark.conf.get(FREE_SHUFFLES, None)
            spark.conf.set(FREE_SHUFFLES, "true")
        _freeing["depth"] += 1
    try:
        yield
    finally:
        with _freeing["lock"]:
            _freeing["depth"] -= 1
            if not _freeing["depth"]:
                before = _freeing["before"]
                spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def in_parallel(spark: SparkSession, steps: Sequence[Callable[[], Result]], at_once: int = 8) -> list[Result]:
    """Run independent steps that each start small jobs (statistics, vocabularies) at the same time."""
    if len(steps) < 2:
        return [step() for step in steps]
    with ThreadPoolExecutor(min(at_once, len(steps))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]
