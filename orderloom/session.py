"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split skewed join may cost the next join its co-partitioning; the extra
    # exchange is only added at run time, when a hot key was really seen.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}

# Only settable when the session starts. Without it every column expression walks
# the Python stack, which for plans of some hundred expressions costs more than
# planning them.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "orderloom", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the engine's settings; extra ``settings`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**START_SETTINGS, **RUNTIME_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session; cluster sizing stays untouched."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: Bytes of input files for one shuffle partition to begin with, and of shuffled data for one task.
#: A task of several joins and aggregates holds its rows, unpacked, once for each of them.
INPUT_PER_PARTITION, SHUFFLED_PER_TASK = 4 << 20, 16 << 20
#: Bytes of input files for one task. Sums per order that begin there hold a row for nearly every row read.
SCANNED_PER_TASK = 16 << 20


def size_shuffles(spark: SparkSession, *paths: str) -> None:
    """Let shuffles begin with a number of partitions that grows with the input.

    Spark joins small ones again when it knows their sizes, and files are read in small parts,
    so that a task's memory stays the same whatever the input. Larger numbers of partitions
    are left alone, and so are sizes of tasks that the session sets.
    """
    size = sum(input_bytes(spark, p) for p in paths)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", max(least, size // INPUT_PER_PARTITION))
    tasks = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": SHUFFLED_PER_TASK,
        "spark.sql.files.maxPartitionBytes": SCANNED_PER_TASK,
    }
    for key, most in tasks.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, most)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it.

    Only a local-mode session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="orderloom-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _folder(spark: SparkSession, path: str):
    """A path and its file system, whatever store it is in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as Python opens it, where it lies in a file system that is mounted."""
    folder, store = _folder(spark, path)
    return store.makeQualified(folder).toUri().getPath() if store.getScheme() == "file" else None


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, store = _folder(spark, path)
    return store.exists(folder)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or of all files in a folder; 0 where there is none."""
    folder, store = _folder(spark, path)
    return store.getContentSummary(folder).getLength() if store.exists(folder) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; nothing where there is none."""
    folder, store = _folder(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(folder)) if store.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    folder, store = _folder(spark, path)
    store.delete(folder, True)


def struct(ddl: str) -> StructType:
    """The schema that a column list describes."""
    return StructType.fromDDL(ddl)


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so runs cannot collide."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch paths made inside it at its end; nothing may read them later."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative jobs a reliable checkpoint folder to cut lineage in."""
    root = scratch_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
