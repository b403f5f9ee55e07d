"""Small files and listings of shared folders, through Hadoop's file systems, so that any scheme works as a local disk does."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is absent; any other failure is raised, never read as an empty folder."""
    p, fs = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet: of two writers of one name, one fails."""
    p, fs = _at(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
