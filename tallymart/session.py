"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

# Day boundaries and timestamp text are read in UTC. AQE picks broadcast or
# sort-merge joins from measured sizes and splits skewed join partitions.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Delete a query's shuffle files at its end.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_freeing: dict[SparkSession, tuple[int, str]] = {}


def build_session(app_name: str = "tallymart", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallymart-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/tallymart/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, frames: Sequence[DataFrame]) -> None:
    """Delete the folders of staged frames that nothing reads any more."""
    base = f"{shared_folder(spark)}/tallymart/"
    for file in {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}:
        if base.split("://")[-1].lstrip("/") in file:
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def observed(seen: Observation, otherwise: Callable[[], int]) -> int:
    """The observed ``rows``; Spark drops the counter of a branch that it finds to be empty
    while it plans, and then ``otherwise`` tells."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return otherwise()


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes within go when each write ends; else they stay until the
    driver's garbage collector finds their frames, which may be after the whole job."""
    with _lock:
        users, before = _freeing.get(spark) or (0, spark.conf.get(_FREE, "false"))
        _freeing[spark] = (users + 1, before)
        spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        with _lock:
            users, before = _freeing.pop(spark)
            if users > 1:
                _freeing[spark] = (users - 1, before)
            else:
                spark.conf.set(_FREE, before)


def together(spark: SparkSession, *jobs: Callable[[], Any]) -> list:
    """Results of jobs that don't wait for one another, run side by side: while one plans or
    commits files, or waits for its last task, the cluster works for the others."""
    wrap = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(job if wrap is spark else wrap(job)) for job in jobs]
    return [r.result() for r in running]


def stage(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``df`` to the shared folder; returns the written rows and their number.

    Later steps start from files, so a lost executor repeats reads and not the work
    behind them. The rows are counted while they are written.
    """
    path = scratch_path(df.sparkSession, name)
    seen = Observation()
    with shuffles_freed(df.sparkSession):
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    return rows, observed(seen, rows.count)
