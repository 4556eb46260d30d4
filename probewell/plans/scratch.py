"""Folders for the files that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder of ``spark.checkpoint.dir``; below a local folder only where that is unset and the master is local."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a shared folder: the master is {master}")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-files-")
        base = _own[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
