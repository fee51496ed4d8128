"""Small files that appear at once and only once, on any Hadoop file system.

Two writers that publish the same path at the same time cannot both win: the
text is written beside it and given its name by an operation that fails when
the name is taken (a hard link on a mounted folder, a rename without overwrite
elsewhere). The store must make that operation atomic, as HDFS and mounted
file systems do.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _place(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _place(spark, path)
    fs.delete(where, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, where = _place(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _place(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Creates ``path`` with ``text``; False, and nothing changed, if it exists."""
    fs, where = _place(spark, path)
    fs.mkdirs(where.getParent())
    # Hidden from listings by Spark's readers and never a version's name.
    beside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_{uuid.uuid4().hex}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        local = fs.getUri().getScheme() == "file"
        return (_link if local else _rename)(spark, beside, where)
    finally:
        fs.delete(beside, False)


def _link(spark: SparkSession, beside, where) -> bool:
    def mounted(path) -> str:
        return unquote(urlparse(path.toUri().toString()).path)

    try:
        os.link(mounted(beside), mounted(where))
    except FileExistsError:
        return False
    return True


def _rename(spark: SparkSession, beside, where) -> bool:
    fs = spark._jvm.org.apache.hadoop.fs
    none = spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
    context = fs.FileContext.getFileContext(beside.getFileSystem(spark._jsc.hadoopConfiguration()).getUri())
    try:
        context.rename(context.makeQualified(beside), context.makeQualified(where), none)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def _files(spark: SparkSession, path: str) -> Iterator[tuple[str, int, int]]:
    fs, where = _place(spark, path)
    found = fs.globStatus(where)
    if not found:
        raise FileNotFoundError(path)
    for top in found:
        listed = fs.listFiles(top.getPath(), True)
        while listed.hasNext():
            status = listed.next()
            if not status.getPath().getName().startswith(("_", ".")):
                yield status.getPath().toString(), status.getLen(), status.getModificationTime()


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """A digest of the names, sizes and times of all files under ``paths``."""
    told = [[path, sorted(_files(spark, path))] for path in paths]
    return hashlib.sha256(json.dumps(told).encode()).hexdigest()
