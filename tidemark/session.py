"""Session helpers: local sessions for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def job_label(spark: SparkSession, text: str) -> Iterator[None]:
    """Label the Spark jobs started by this thread (event logs, job listings)."""
    sc = spark.sparkContext
    prev = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(f"tidemark: {text}")
    try:
        yield
    finally:
        sc.setLocalProperty("spark.job.description", prev)


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", extra: dict[str, str] | None = None
                  ) -> SparkSession:
    """A local session tuned like a small cluster: AQE on, UI off, UTC."""
    n = shuffle_partitions or (os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide work folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set (a shared, fault-tolerant file system); unset, it
    is an error there. On a local master a folder of our own is created and
    registered, so ``DataFrame.checkpoint()`` works as well.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current and not (sc.master or "").split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not current:
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared work folder (one per run)."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/tidemark/{label}-{uuid.uuid4().hex[:12]}"
