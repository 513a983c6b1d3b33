"""Where intermediate tables go."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, empty folder below the one that the cluster shares; write with ``overwrite``.

    The folder is the session's ``spark.checkpoint.dir``. A temporary folder of
    this machine is used only in local mode; on a cluster executors could not
    see it, so the setting is required there. The folders are removed when the
    driver's JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    hadoop_path, files = _hadoop(spark, path)
    # Only a path that exists can be marked for removal.
    files.mkdirs(hadoop_path)
    files.deleteOnExit(hadoop_path)
    return path


def _hadoop(spark: SparkSession, path: str):
    """A path as Hadoop knows it, and its file system."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


_stored: dict[tuple, str] = {}


def stored_once(spark: SparkSession, source: str, label: str, write: Callable[[str], None]) -> str:
    """A folder that ``write`` has filled from the files at ``source``, once in an application.

    It is filled anew when the source's size or time has changed, or when it is gone.
    """
    path, files = _hadoop(spark, source)
    status = files.getFileStatus(path)
    # A folder's time changes with the files in it.
    state = (status.getLen(), status.getModificationTime())
    key = (spark.sparkContext.applicationId, source, label)
    known = _stored.get((*key, *state))
    if known is not None:
        stored, where = _hadoop(spark, known)
        if where.exists(stored):
            return known
    made = scratch_path(spark, label)
    write(made)
    _stored[(*key, *state)] = made
    return made
