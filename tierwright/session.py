"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Reasonable defaults for any cluster size.  Parallelism and memory are left to
# the cluster; AQE sizes shuffle partitions, splits skewed join partitions and
# picks broadcast joins only below Spark's own size threshold.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are compared as UTC wall clock, so the session must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="tierwright-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever reused or cleared."""
    return os.path.join(shared_root(spark), "tierwright", f"{label}-{uuid.uuid4().hex[:12]}")


# Spark's setting to drop the shuffle files of a query when it ends, rather than when the driver collects garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_dropping: Counter = Counter()
_before: dict[str, str] = {}
_drop_lock = threading.Lock()


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun meanwhile leave no shuffle files; several threads may be inside at once."""
    session = spark._jsparkSession.sessionUUID()
    with _drop_lock:
        if not _dropping[session]:
            _before[session] = spark.conf.get(DROP_SHUFFLES)
            spark.conf.set(DROP_SHUFFLES, "true")
        _dropping[session] += 1
    try:
        yield
    finally:
        with _drop_lock:
            _dropping[session] -= 1
            if not _dropping[session]:
                spark.conf.set(DROP_SHUFFLES, _before.pop(session))


def run_together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run independent Spark actions from separate driver threads.

    Results come in the order of ``jobs``.  At the first error the Spark jobs of the others are cancelled by
    their tag, so that a broken source does not wait for a long one, and that error is raised.
    """
    context = spark.sparkContext
    tag = f"together-{uuid.uuid4().hex}"
    failed = threading.Event()

    def tagged(job: Callable[[], object]) -> object:
        context.addJobTag(tag)
        try:
            if failed.is_set():
                raise RuntimeError("not started: another job failed")
            return job()
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(tagged), job) for job in jobs]
        done, waiting = wait(futures, return_when=FIRST_EXCEPTION)
        first = next((f.exception() for f in futures if f in done and f.exception()), None)
        if first is not None:
            failed.set()
            while waiting:
                # a job between two actions has nothing to cancel yet
                context.cancelJobsWithTag(tag)
                _, waiting = wait(waiting, timeout=0.2)
            raise first
        return [f.result() for f in futures]
