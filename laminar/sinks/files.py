"""Small file-system steps on the driver: manifests, ledgers, renames.

Paths go to the Hadoop file system that serves them. Nothing here reads data; texts are
manifests whose size is bounded by days, buckets or the files of one batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, Path) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder (none if it is missing), in order."""
    fs, p = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Write a text beside its place and rename it there, so that a reader sees all of it or
    nothing. Without ``replace`` an existing file stays, and the answer is False."""
    folder, name = path.rsplit("/", 1)
    fs, part = file_system(spark, f"{folder}/.{name}.{uuid.uuid4().hex[:8]}.part")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _, place = file_system(spark, path)
    if replace and fs.exists(place):
        fs.delete(place, False)
    if fs.exists(place) or not fs.rename(part, place):
        fs.delete(part, False)
        return False
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, s = file_system(spark, source)
    _, t = file_system(spark, target)
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, p = file_system(spark, path)
    return fs.getContentSummary(p).getLength()
