"""Zip archives of XML filings.

``binaryFile`` holds a whole archive in one row, so a folder scan only lists
the archives. A first pass reads their directories and cuts the members into
chunks of bounded size; the chunks are spread over the cluster and each task
reads its own members from storage. One archive holding a third of all
filings is read by as many tasks as its size asks for.
"""

from __future__ import annotations

import math
import zipfile
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from almsflow.operators.extract import DOCUMENT_SCHEMA, archive_documents, extract_members, in_batches, xml_members
from almsflow.plans.specs import SPECS, Spec
from almsflow.sources.files import landed, listing, open_path

CHUNK_BYTES = 128 << 20
CHUNK_MEMBERS = 4000
#: Reading tasks per slot of the cluster at most; beyond that a task reads several chunks.
TASKS_PER_SLOT = 64
CHUNK_SCHEMA = "path string, chunk int, members array<string>, error string"


def _chunks(row: dict) -> Iterator[dict]:
    path = row["path"]
    try:
        with open_path(path) as source, zipfile.ZipFile(source) as archive:
            infos = xml_members(archive)
    except (zipfile.BadZipFile, OSError, ValueError) as problem:
        yield {"path": path, "chunk": 0, "error": f"unreadable_archive: {problem}"}
        return
    chunk, names, size = 0, [], 0
    for info in infos:
        names.append(info.filename)
        size += info.compress_size
        if size >= CHUNK_BYTES or len(names) == CHUNK_MEMBERS:
            yield {"path": path, "chunk": chunk, "members": names}
            chunk, names, size = chunk + 1, [], 0
    if names:
        yield {"path": path, "chunk": chunk, "members": names}


def member_chunks(archives: DataFrame) -> DataFrame:
    """``(path, chunk, members, error)`` of listed archives, spread for reading."""
    total = archives.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    slots = archives.sparkSession.sparkContext.defaultParallelism
    width = min(max(4 * slots, math.ceil(total / CHUNK_BYTES)), TASKS_PER_SLOT * slots)
    files = archives.select("path").repartition(width, "path")
    # The count is explicit so that adaptive execution, which sees only the
    # tiny chunk rows, does not fold the reading work into few tasks.
    return files.mapInArrow(in_batches(_chunks, CHUNK_SCHEMA), CHUNK_SCHEMA).repartition(width, "path", "chunk")


def zip_listing(spark: SparkSession, directory: str) -> DataFrame:
    return landed(listing(spark, directory, "*.zip"))


def scan_documents(spark: SparkSession, directory: str) -> DataFrame:
    """``(zip_name, member, xml, error)`` of every XML member below ``directory``."""
    def read(row: dict) -> Iterator[dict]:
        zip_name = row["path"].rsplit("/", 1)[-1]
        if row["error"]:
            yield {"zip_name": zip_name, "error": row["error"]}
            return
        with open_path(row["path"]) as source:
            yield from archive_documents(zip_name, source, list(row["members"]))

    chunks = member_chunks(zip_listing(spark, directory))
    return chunks.mapInArrow(in_batches(read, DOCUMENT_SCHEMA), DOCUMENT_SCHEMA)


def extract_archives(archives: DataFrame, specs: Sequence[Spec] = SPECS, wide: bool = False) -> DataFrame:
    """Dataset rows of listed archives, and a row with ``error`` for each that cannot be read.

    Directories are read once, members are read and parsed in one pass. ``wide`` gives a column per field.
    """
    return extract_members(member_chunks(archives), open_path, specs, wide)
