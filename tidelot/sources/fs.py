"""Small JSON pointers and manifests on any Hadoop file system."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path``; none when it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def read_json(spark: SparkSession, path: str) -> dict:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small new file."""
    fs, target = _open(spark, path)
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Replace a small JSON file in one step; a reader sees the old or the new content, never half of one."""
    fs, target = _open(spark, path)
    beside = target.suffix(f".{uuid.uuid4().hex}.tmp")
    write_bytes(spark, beside.toString(), json.dumps(value, ensure_ascii=False, indent=2, default=str).encode("utf-8"))
    _move_over(spark, fs, beside, target)


def create_json(spark: SparkSession, path: str, value: dict) -> bool:
    """Write a small JSON file only where none of its name is there; false where there is one.

    The content is written beside it and renamed without overwriting, which a file system refuses to all but the first.
    """
    fs, target = _open(spark, path)
    if fs.exists(target):
        return False
    beside = target.suffix(f".{uuid.uuid4().hex}.tmp")
    write_bytes(spark, beside.toString(), json.dumps(value, ensure_ascii=False, indent=2, default=str).encode("utf-8"))
    try:
        _rename(spark, fs, beside, target, "NONE")
    except Py4JJavaError as failure:
        if "FileAlreadyExistsException" not in failure.java_exception.getClass().getName():
            raise
        return False
    finally:
        fs.delete(beside, False)
    return True


def _move_over(spark: SparkSession, fs, source, target) -> None:
    _rename(spark, fs, source, target, "OVERWRITE")


def _rename(spark: SparkSession, fs, source, target, how: str) -> None:
    jvm = spark.sparkContext._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.valueOf(how)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(source), fs.makeQualified(target), options)


def list_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Names of the files under ``path`` that end with ``suffix``; none when it does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isFile()]
    return sorted(n for n in names if n.endswith(suffix) and not n.startswith("."))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote."""
    fs, target = _open(spark, path)
    fs.delete(target, True)


def is_inside(root: str, path: str) -> bool:
    """True when a relative pointer stays below its root."""
    parts = [p for p in path.split("/") if p]
    return bool(parts) and not path.startswith("/") and ":" not in path and ".." not in parts
