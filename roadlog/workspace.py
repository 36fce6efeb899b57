"""Where intermediate tables go.

A cluster names a shared folder in ``spark.checkpoint.dir``; that setting is
always honoured.  Only a session whose tasks run in its own process (``local[*]``)
and that names no folder gets one, which goes when the process ends.  Elsewhere
the tables stay until :func:`clear` (a result that is not yet written may still
read them).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# folders of this process, removed at its end
_own: list[tempfile.TemporaryDirectory] = []
# tables written for the session of each shared folder, for clear()
_made: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, without a trailing slash."""
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder that all executors can reach")
        _own.append(tempfile.TemporaryDirectory(prefix="roadlog-", ignore_cleanup_errors=True))
        folder = _own[-1].name
        spark.conf.set(_SETTING, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder (not created yet)."""
    shared = shared_folder(spark)
    path = f"{shared}/{label}-{uuid.uuid4().hex}"
    _made.setdefault(shared, []).append(path)
    return path


def written(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back, so later uses share one computation
    and survive the loss of executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark can reach, if it is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def clear(spark: SparkSession) -> None:
    """Remove what this process has put into the shared folder; call it when the
    results of a job are written."""
    for path in _made.pop(shared_folder(spark), []):
        remove_folder(spark, path)
