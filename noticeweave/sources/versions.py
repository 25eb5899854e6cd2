"""Tables of numbered versions. Each is a folder of its own that is never changed; a pointer file names the one that counts, and putting
another in its place is one atomic rename. Whoever has opened a version keeps reading it."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from noticeweave.operators.durable import drop_folder

POINTER, _NAME = "current", re.compile(r"v(\d{8})-[0-9a-f]{32}")


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[str]:
    """The names of all versions that are there, oldest first; unfinished ones too."""
    place, system = _system(spark, path)
    if not system.exists(place):
        return []
    return sorted(name for name in (s.getPath().getName() for s in system.listStatus(place)) if _NAME.fullmatch(name))


def current(spark: SparkSession, path: str) -> str | None:
    """The version that counts, None before the first."""
    place, system = _system(spark, f"{path}/{POINTER}")
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def point(spark: SparkSession, path: str, version: str, before: str | None = None) -> None:
    """Makes a version count, an older one too. With `before` it refuses if another one counts by now."""
    if before is not None and current(spark, path) != before:
        raise OSError(f"{path} was changed: {before} no longer counts")
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    beside, system = _system(spark, f"{path}/.{POINTER}-{uuid.uuid4().hex}")
    out = system.create(beside)
    out.write(bytearray(version.encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = gateway.new_array(kind, 1)
    overwrite[0] = kind.OVERWRITE
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/{POINTER}")
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration()).rename(beside, place, overwrite)


def read_version(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """A version's rows, the current one's if none is named. The frame stays with this version whatever is written later."""
    version = version or current(spark, path)
    if version is None:
        raise FileNotFoundError(f"{path} has no version yet")
    return spark.read.parquet(f"{path}/{version}")


def write_version(df: DataFrame, path: str) -> DataFrame:
    """Writes df as the next version, though it may be computed from the current one, and makes it count when it is whole; returns it. A
    writer that stops before leaves the table as it was, and of two writers the later to end wins."""
    spark = df.sparkSession
    numbers = [int(_NAME.fullmatch(v)[1]) for v in versions(spark, path)]
    version = f"v{max(numbers, default=0) + 1:08d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    point(spark, path, version)
    return read_version(spark, path, version)


def drop_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Removes all but the newest `keep` versions and the current one, for which no reader or writer is left; returns their names."""
    held = current(spark, path)
    old = [v for v in versions(spark, path)[: -keep or None] if v != held]
    for version in old:
        drop_folder(spark, f"{path}/{version}")
    return old
