"""Where intermediate files go.

Files that several executors read or write must lie in a folder they share.
The cluster names it in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The session's shared folder; a temporary one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used before."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
