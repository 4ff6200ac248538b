"""Small files in a folder that the driver and all executors share, by Hadoop's file systems: lists, texts, files made just once."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none where there is no such folder."""
    fs, at = _at(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet; false if it does, and nothing changes."""
    fs, at = _at(spark, path)
    try:
        out = fs.create(at, False)
    except Py4JJavaError as failed:
        if "FileAlreadyExists" in failed.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def remove(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all that is in it; nothing happens where there is none."""
    fs, at = _at(spark, path)
    fs.delete(at, True)
