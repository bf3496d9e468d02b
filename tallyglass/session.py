"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # The JVM never compiles methods above 8000 bytes of bytecode, so generated
    # code beyond that would be interpreted; fall back to smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "tallyglass", **extra: str) -> SparkSession:
    """A session with the settings the jobs assume.

    On a cluster leave ``master`` out and let spark-submit decide; partition
    counts are left to AQE there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables a job writes and reads back.

    Uses the shared folder named by ``spark.checkpoint.dir``.  Only a session
    whose tasks all run in the driver's own process falls back to a temp folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallyglass-")
    path = os.path.join(base, "tallyglass", f"{name}-{uuid.uuid4().hex}")
    for owned in _AREAS:
        owned.append(path)
    return path


_AREAS: list[list[str]] = []


@contextmanager
def work_area(spark: SparkSession) -> Iterator[None]:
    """Owns the work tables made inside it and removes them at the end.

    Frames built inside read those tables, so write or collect results before
    leaving.
    """
    owned: list[str] = []
    _AREAS.append(owned)
    try:
        yield
    finally:
        # By identity: two areas without tables are equal lists.
        _AREAS[:] = [a for a in _AREAS if a is not owned]
        for path in owned:
            remove_tree(spark, path)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the work folder and read it back.

    Used where several branches of a later plan start from a costly result:
    it is computed once, its lineage is cut, and a lost executor costs a file
    read instead of the whole chain.
    """
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run inside go as soon as it ends; else they stay until the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def settle_from(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives, stored as by :func:`settle`; the tables and shuffles made for it alone are removed."""
    path = work_folder(spark, name)  # outside the area
    with work_area(spark), shuffles_removed(spark):
        df = make()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*jobs: Callable) -> list:
    """Results of jobs that need nothing of each other, run at the same time, in the order given.

    A source of one file or few partitions leaves cores idle; Spark's own scheduler gives them to the others.
    """
    with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(j)) for j in jobs]]
