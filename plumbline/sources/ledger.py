"""Folders of numbered entries that are never changed: whoever puts the next number first has it.

An entry appears whole or not at all. On file systems with an atomic rename (HDFS) a finished file is renamed to
its number, on a local disk it is linked there, and both fail where the number exists. Object stores have no such
rename; there the file is created under its number on condition that it does not exist (with S3, conditional writes).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: File systems on which renaming copies.
OBJECT_STORES = {"s3", "s3a", "s3n", "gs", "oss", "cosn", "obs"}


def _hadoop(spark: SparkSession, path: str):
    """The classes of Hadoop's file system, a path, and the file system it is on."""
    classes = spark.sparkContext._jvm.org.apache.hadoop.fs
    found = classes.Path(path)
    return classes, found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _is(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


def _write(fs, path, text: str, may_exist: bool = False) -> None:
    out = fs.create(path, may_exist)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one; of several writers exactly one gets true."""
    classes, target, fs = _hadoop(spark, path)
    if fs.getUri().getScheme() in OBJECT_STORES:
        try:
            _write(fs, target, text)
        except Py4JJavaError as error:
            if _is(error, "FileAlreadyExistsException", "RemoteFileChangedException"):
                return False
            raise
        return True
    draft = classes.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    _write(fs, draft, text)
    try:
        if fs.getUri().getScheme() != "file":
            return fs.rename(draft, target)
        java = spark.sparkContext._jvm.java
        java.nio.file.Files.createLink(*(java.io.File(p.toUri().getPath()).toPath() for p in (target, draft)))
        return True
    except Py4JJavaError as error:
        if _is(error, "FileAlreadyExistsException"):
            return False
        raise
    finally:
        fs.delete(draft, False)


def entries(spark: SparkSession, folder: str) -> list[str]:
    """The texts of all entries in their order; none where there is no folder."""
    _, path, fs = _hadoop(spark, folder)
    try:
        found = [status.getPath() for status in fs.listStatus(path)]
    except Py4JJavaError as error:
        if not _is(error, "FileNotFoundException"):
            raise
        return []
    texts = []
    for entry in sorted((p for p in found if not p.getName().startswith(".")), key=lambda p: p.getName()):
        stream = fs.open(entry)
        try:
            texts.append(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
    return texts


def append(spark: SparkSession, folder: str, make: Callable[[list[str]], str]) -> int:
    """Add an entry and return its number, from 1. ``make`` gives its text from the entries before it, and is
    asked again when somebody else was first."""
    while True:
        before = entries(spark, folder)
        number = len(before) + 1
        if put_if_absent(spark, f"{folder}/{number:012d}.json", make(before)):
            return number


def exists(spark: SparkSession, path: str) -> bool:
    _, target, fs = _hadoop(spark, path)
    return fs.exists(target)


def delete_folder(spark: SparkSession, path: str) -> bool:
    _, target, fs = _hadoop(spark, path)
    return fs.delete(target, True)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Let a finished folder take the place of another; a reader finds the old one, none, or the new one whole."""
    _, target, fs = _hadoop(spark, path)
    fs.mkdirs(target.getParent())
    fs.delete(target, True)
    if not fs.rename(_hadoop(spark, new)[1], target):
        raise OSError(f"cannot move {new} to {path}")
