"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _inside = threading.Lock(), {"threads": 0, "before": None}


def local_session(app: str = "stratamart", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A small local session for tests and the benchmark; a cluster brings its own."""
    parallel = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session without that setting gets a folder made for it; on a cluster a
    machine-local folder would be lost with its machine, so that case is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it Spark drops the shuffle files of each action when the action ends, not when the driver next collects garbage.

    For work whose results are written and read again. Several threads may be inside; the last one to leave restores the setting.
    """
    with _lock:
        if not _inside["threads"]:
            _inside["before"] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _inside["threads"] += 1
    try:
        yield
    finally:
        with _lock:
            _inside["threads"] -= 1
            if not _inside["threads"]:
                before = _inside["before"]
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
