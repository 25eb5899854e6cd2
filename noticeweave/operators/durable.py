"""Tables written to the folder that all executors share, so that a lost executor costs no more than its own tasks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders made inside the scratch() blocks that are open, innermost last.
_open: list[list[str]] = []


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, on Spark's default file system if it names none; where it is unset a new temporary
    one, which only a local master can share with its tasks."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        path, system = _path(spark, root)
        return path.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if getattr(spark, "_noticeweave_root", None) is None:
        spark._noticeweave_root = "file://" + tempfile.mkdtemp(prefix="noticeweave-")
    return spark._noticeweave_root


def new_folder(spark: SparkSession, name: str) -> str:
    folder = f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for made in _open:
        made.append(folder)
    return folder


def durable(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and its rows are computed once."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._durable_path = path
    return out


def drop_folder(spark: SparkSession, folder: str) -> None:
    path, system = _path(spark, folder)
    system.delete(path, True)


def drop_durable(df: DataFrame) -> None:
    """Removes the files of a table that durable() returned, if nothing needs them any more; other frames are left alone."""
    folder = getattr(df, "_durable_path", None)
    if folder:
        drop_folder(df.sparkSession, folder)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Removes at its end what was written to the shared folder inside, but for the durable tables put into the list."""
    kept: list[DataFrame] = []
    _open.append([])
    try:
        yield kept
    finally:
        left = {getattr(df, "_durable_path", None) for df in kept}
        for folder in _open.pop():
            if folder not in left:
                drop_folder(spark, folder)
