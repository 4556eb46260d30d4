"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local one where it is unset and the master is local (tests in one process)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that driver and executors share: the master is {master}, and a local folder of each machine would lose rows")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-llm-")
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once as Parquet in the shared folder and read them back; this cuts the lineage.

    Shuffle files of the write go as soon as it has ended: nothing reads them again.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def drop(df: DataFrame) -> None:
    """Delete the files of a table of ``save`` that nothing reads any more."""
    fs, place = _fs(df.sparkSession, df._saved_at)
    fs.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _fs(spark, path)
    return fs.exists(place)
