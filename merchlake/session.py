"""Session settings and the shared folder used for checkpoints and staging."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every operator relies on; all of them can be set at run time.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffle files go when their query ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Rows written by partition aren't sorted by it first, as long as a task meets no more partitions than this.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "merchlake", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        # Noting the Python call site of every expression takes longer than planning does.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return configure(builder.getOrCreate())


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named in ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local master with the setting unset:
    a folder on one machine would not survive the loss of an executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(context.applicationId)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="merchlake-")
        _LOCAL_DIRS[context.applicationId] = folder
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_SCRATCH: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has written to yet; within ``scratch``, below its folder."""
    return f"{_SCRATCH[-1] if _SCRATCH else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder that takes all fresh paths of a job and goes, with what they hold, when the job ends."""
    path = fresh_path(spark, name)
    _SCRATCH.append(path)
    try:
        yield path
    finally:
        _SCRATCH.pop()
        delete(spark, path)
