"""Names and small files in a file system, by Spark's own file-system layer, so that
any path Spark reads works the same."""

from __future__ import annotations

import os
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path``, sorted."""
    fs, hpath = _fs(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(hpath))


def _local(fs, hpath) -> str | None:
    """The path on this machine, where the file system is a local one."""
    return hpath.toUri().getPath() if fs.getScheme() == "file" else None


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Make a whole new file at once; False if there is one already.

    Of any number of callers one gets True, also on different machines: the file
    is written aside and then linked (a local folder) or renamed (others) to
    its name, which both fail where the name is taken."""
    fs, hpath = _fs(spark, path)
    here = _local(fs, hpath)
    if here is not None:
        os.makedirs(os.path.dirname(here), exist_ok=True)
        aside = f"{os.path.dirname(here)}/.{uuid.uuid4().hex}"
        with open(aside, "x", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(aside, here)
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
        return True
    jvm = spark.sparkContext._jvm
    aside = jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(hpath.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    plain[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(aside, hpath, plain)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True


def touch(spark: SparkSession, path: str) -> None:
    """Set a file's time of change to now."""
    fs, hpath = _fs(spark, path)
    fs.setTimes(hpath, int(time.time() * 1000), -1)


def seconds_since_change(spark: SparkSession, path: str) -> float | None:
    """How long ago a file was changed; None if there is none."""
    fs, hpath = _fs(spark, path)
    try:
        return time.time() - fs.getFileStatus(hpath).getModificationTime() / 1000.0
    except Py4JJavaError:
        return None


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder, if it is there."""
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)
