"""Intermediate tables in the shared folder that the cluster names in ``spark.checkpoint.dir``.

A written table survives the loss of an executor, cuts the lineage and is read back with column
pruning, so it serves where a frame is used more than once or must not be computed twice with a
different row placement.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse import settings

_local_folders: dict[str, str] = {}
#: Paths of the innermost ``temporary`` block of this thread or task; None outside.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only for an unset local session (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tillhouse-")
    return _local_folders[app]


def fresh_path(spark: SparkSession) -> str:
    """A path in the shared folder that is deleted with its ``temporary`` block, or with the session."""
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.append(path)
    else:  # goes with the session at the latest
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables pinned inside the block are deleted at its end, when their readers have been stored.

    Blocks in other threads keep their own tables. What is pinned outside any block is deleted when
    the session's JVM ends.
    """
    before = _scope.set([])
    try:
        yield
    finally:
        names = _scope.get()
        _scope.reset(before)
        for name in names:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pin(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to a fresh table in the shared folder and return a reader of it."""
    path = fresh_path(df.sparkSession)
    if partition_by:
        df.hint("rebalance", *[F.col(c) for c in partition_by]).write.partitionBy(*partition_by).orc(path)
    else:
        df.write.orc(path)
    return df.sparkSession.read.schema(df.schema).orc(path)


def land_lines(df: DataFrame) -> str:
    """Write each row as one JSON line to fresh compressed text files, as a log collector does; returns the folder.

    Such files are read whole, so one holds ``LOG_LINES`` lines at most.
    """
    path = fresh_path(df.sparkSession)
    lines = df.select(F.to_json(F.struct("*")))
    lines.write.option("maxRecordsPerFile", settings.LOG_LINES).text(path, compression="gzip")
    return path
