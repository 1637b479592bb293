"""Paths on the cluster's file system, through the Hadoop API Spark itself uses."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for intermediate data, under ``spark.checkpoint.dir``.

    Executors must all see it, so a machine-local folder is used only in local
    mode and only where the setting is absent.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tablesync-")
    return f"{base.rstrip('/')}/tablesync/{label}-{uuid4().hex}"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host, without a trailing slash."""
    fs, p = _open(spark, path)
    return fs.makeQualified(p).toUri().toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether Spark would find a data file in the folder or its partition folders."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return False
    base, files = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/", fs.listFiles(p, True)
    while files.hasNext():
        parts = files.next().getPath().toUri().getPath().removeprefix(base).split("/")
        if not any(n.startswith(".") or (n.startswith("_") and "=" not in n) for n in parts):
            return True
    return False


def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """The data files Spark would find under the folder: path inside it, and bytes."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return {}
    base, files, found = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/", fs.listFiles(p, True), {}
    while files.hasNext():
        status = files.next()
        name = status.getPath().toUri().getPath().removeprefix(base)
        if not any(n.startswith(".") or (n.startswith("_") and "=" not in n) for n in name.split("/")):
            found[name] = status.getLen()
    return found


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names directly in a folder; none if there is no folder."""
    fs, p = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_whole(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, ended by a line break; ``FileExistsError`` if somebody made it first.

    A reader that finds no line break at the end met a writer that was cut off.
    """
    fs, p = _open(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    try:
        out = fs.create(p, False)  # the file system refuses a second creator
    except Py4JJavaError as error:
        if fs.exists(p):
            raise FileExistsError(path) from error
        raise
    out.write(bytearray((text + "\n").encode()))
    out.close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _open(spark, source)
    parent = spark._jvm.org.apache.hadoop.fs.Path(target).getParent()
    if not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    if fs.exists(p) and not fs.delete(p, True):
        raise OSError(f"could not delete {path}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file; an error if there is one already."""
    fs, p = _open(spark, path)
    fs.create(p, False).close()
