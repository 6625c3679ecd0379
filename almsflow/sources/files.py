"""Landed files: listing, validity, inventory and opening one inside a task."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from fnmatch import fnmatch

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from almsflow.functions.text import megabytes

LISTING = "path string, modificationTime timestamp, length long, content binary"


def listing(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """``(path, modificationTime, length)`` of a folder's files; contents are never read.

    Spark's file scan leaves out empty files by itself.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
            .select("path", "modificationTime", "length"))


def landed(files: DataFrame) -> DataFrame:
    """Only files that hold something."""
    return files.filter("length > 0")


def file_name(path: str = "path"):
    return F.regexp_extract(F.col(path), r"([^/]+)$", 1)


def entries(directory: str, missing_ok: bool = False) -> list[tuple[str, int, object]]:
    """Path, size and time of a folder's files as the store lists them, empty ones included."""
    store, inner = _store(directory)
    if missing_ok and store.get_file_info(inner).type == pafs.FileType.NotFound:
        return []
    head = directory.rstrip("/")
    return [(f"{head}/{e.base_name}", e.size, e.mtime_ns) for e in store.get_file_info(pafs.FileSelector(inner))
            if e.type == pafs.FileType.File and not e.base_name.startswith((".", "_"))]


def inventory(spark: SparkSession, directory: str, pattern: str = "*") -> DataFrame:
    """Every file of a folder with its size, and whether it holds anything.

    The entries come from the store's own listing, because Spark's file scan leaves out empty files.
    """
    store, inner = _store(directory)
    found = [(e.base_name, e.size, e.mtime) for e in store.get_file_info(pafs.FileSelector(inner))
               if e.type == pafs.FileType.File and fnmatch(e.base_name, pattern) and not e.base_name.startswith((".", "_"))]
    listed = spark.createDataFrame(found, "name string, size_bytes long, modified timestamp")
    return listed.select("name", "size_bytes", megabytes(F.col("size_bytes")).alias("size_mb"), "modified",
                        (F.col("size_bytes") > 0).alias("valid"))


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    scheme, _, rest = path.partition(":")
    if not rest or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (rest or path).lstrip("/")
    return pafs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}:{rest}")


def exists(path: str) -> bool:
    store, inner = _store(path)
    return store.get_file_info(inner).type != pafs.FileType.NotFound


def open_path(path: str):
    """Seekable file on whatever store a Spark path names (local, HDFS, S3, GCS)."""
    store, inner = _store(path)
    return store.open_input_file(inner)


def write_path(path: str, content: bytes) -> None:
    """Write a whole file, replacing one of that name, so that a repeated task does no harm."""
    store, inner = _store(path)
    store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(inner) as out:
        out.write(content)


@contextmanager
def replace_file(path: str) -> Iterator:
    """A stream whose content takes the place of ``path`` when it is closed without an error.

    A task that is lost or repeated leaves either no file of that name or a whole one.
    """
    store, inner = _store(path)
    folder, name = inner.rsplit("/", 1)
    store.create_dir(folder, recursive=True)
    unfinished = f"{folder}/_{name}-{uuid.uuid4().hex}"
    try:
        with store.open_output_stream(unfinished) as out:
            yield out
        store.move(unfinished, inner)
    except BaseException:
        if store.get_file_info(unfinished).type != pafs.FileType.NotFound:
            store.delete_file(unfinished)
        raise
