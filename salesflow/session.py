"""Spark session and scratch space."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "salesflow", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution.

    ``master`` and ``shuffle_partitions`` are left to spark-submit / the cluster
    defaults when not given.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@functools.cache
def _own_folder() -> str:
    """One folder for a local run, removed at its end."""
    path = tempfile.mkdtemp(prefix="salesflow-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared ``spark.checkpoint.dir``.

    A machine-local folder is used only where that setting is absent *and* the
    session is local; on a cluster its absence is an error, because executors
    would each see a different disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the write that made them ends, not when the driver next collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


# What a write shuffles and sorts lies on disk several times over: a table of more than ROUND_BYTES is taken in rounds,
# up to MOST_ROUNDS of them, and only one round's is there at a time. Each round reads the table again.
ROUND_BYTES = 64 << 20
MOST_ROUNDS = 8


def stored_bytes(df: DataFrame) -> int:
    """How much a frame is by Spark's own estimate; for plain files their size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def rounds_of(df: DataFrame) -> int:
    """In how many rounds a frame is shuffled."""
    return max(1, min(MOST_ROUNDS, -(-stored_bytes(df) // ROUND_BYTES)))


def stage(df, name: str):
    """Write ``df`` to the shared folder and read it back: the lineage ends here.

    Used where a result feeds several jobs. Unlike a cached frame it outlives
    lost executors without recomputing what came before.
    """
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
