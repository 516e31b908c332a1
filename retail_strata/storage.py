"""Names, sizes and markers of stored files, through the file system that Spark uses for a path.

Nothing here reads tables; only a file's first line is ever opened.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import SparkSession

#: Marker that a folder's output is complete.
DONE = "_SUCCESS"

#: Codec of written Parquet tables: about two thirds of the bytes of Spark's default.
PARQUET_CODEC = "zstd"


class Entry(NamedTuple):
    path: str
    name: str
    is_file: bool
    modified: int
    size: int


def _open(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _entry(status) -> Entry:
    path = status.getPath()
    return Entry(
        path.toString(), path.getName(), status.isFile(), status.getModificationTime(), status.getLen()
    )


def hidden(name: str) -> bool:
    """Whether Spark takes a file or folder of this name for no data."""
    return name.startswith((".", "_"))


def exists(spark: SparkSession, path: str) -> bool:
    system, jvm_path = _open(spark, path)
    return system.exists(jvm_path)


def entries(spark: SparkSession, folder: str) -> list[Entry] | None:
    """What lies in a folder, markers included; None if there is no such folder."""
    system, path = _open(spark, folder)
    return [_entry(s) for s in system.listStatus(path)] if system.exists(path) else None


def matches(spark: SparkSession, pattern: str) -> list[Entry]:
    """Files and folders of a path, which may hold wildcards; names that exist as such go first."""
    system, path = _open(spark, pattern)
    if system.exists(path):
        return [_entry(system.getFileStatus(path))]
    return [_entry(s) for s in system.globStatus(path) or () if not hidden(s.getPath().getName())]


def files_below(spark: SparkSession, folder: str) -> Iterator[Entry]:
    """Data files at any depth below a folder, as the listing goes on."""
    system, path = _open(spark, folder)
    depth = len(path.toUri().getPath().rstrip("/").split("/"))
    found = system.listFiles(path, True)
    while found.hasNext():
        status = found.next()
        inside = status.getPath().toUri().getPath().split("/")[depth:]
        if not any(map(hidden, inside)):
            yield _entry(status)


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str | None:
    """A text file's first line, uncompressed by its name; None if it is empty."""
    system, jvm_path = _open(spark, path)
    jvm = spark._jvm
    stream = system.open(jvm_path)
    try:
        codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
        codec = codecs.getCodec(jvm_path)
        plain = stream if codec is None else codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, encoding)).readLine()
    finally:
        stream.close()
    return None if line is None else line.removeprefix("﻿")


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, or leave the one that is there."""
    system, jvm_path = _open(spark, path)
    if not system.exists(jvm_path):
        system.create(jvm_path, False).close()


def remove(spark: SparkSession, path: str) -> None:
    system, jvm_path = _open(spark, path)
    system.delete(jvm_path, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename within a store; the new name must be free."""
    system, jvm_path = _open(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    if system.exists(target) or not system.rename(jvm_path, target):
        raise FileExistsError(f"{old} could not be moved to {new}")
