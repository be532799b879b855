"""Session factory and shared-storage helpers.

The library never assumes a machine-local scratch folder: intermediate stages
and streaming checkpoints live under ``spark.checkpoint.dir``, which a cluster
points at shared storage.  Only when that setting is absent (unit tests, a
laptop) do we fall back to a folder of our own.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this library relies on.
#  * UTC session zone: hour/date of zone-aware timestamps never depend on the host.
#  * ANSI on: bad casts fail loudly; the library uses the ``try_`` forms on purpose.
#  * AQE with partition coalescing and skew-join splitting for runtime re-planning.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = "local[*]",
    app_name: str = "meterlens",
    shuffle_partitions: int | None = None,
    initial_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied.

    ``master=None`` leaves the master to ``spark-submit``.  AQE merges small
    shuffle partitions but never adds any, so for large data give it enough to
    start from: ``initial_partitions`` (about shuffled bytes / 128 MB).
    ``shuffle_partitions`` fixes the width instead (tests).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if initial_partitions:
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect client (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect raises on access
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    directory).  Only a local-mode session without one gets a folder of our own
    (tests, a laptop); on a cluster a machine-local folder would be invisible to
    other executors, so an unset root is an error there.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not configured and not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at shared storage (stages and "
            "streaming checkpoints live there)"
        )
    root = configured or os.path.join(tempfile.gettempdir(), "meterlens-checkpoints")
    if sc is None:
        return root
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _store(spark: SparkSession, path: str):
    """(file system, path) of a path, through Spark; not on a Spark Connect client."""
    sc = _context(spark)
    if sc is None:
        raise RuntimeError("a Spark Connect client has no access to the file system")
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    store, target = _store(spark, path)
    return store.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none when there is no such folder."""
    store, target = _store(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(target)) if store.exists(target) else []


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder that the library made itself; fails when ``to`` is there."""
    store, source = _store(spark, path)
    _, target = _store(spark, to)
    store.mkdirs(target.getParent())
    if store.exists(target) or not store.rename(source, target):
        raise FileExistsError(f"cannot move {path} to {to}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library made itself, through Spark's file system.

    Does nothing on a Spark Connect client, which has no file-system access.
    """
    sc = _context(spark)
    if sc is None:
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go when it ends, not when the driver collects its garbage.

    For loops that write each step and read it back: a frame that is run again is computed anew.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
