"""Zip archives of XML as a Spark data source, for batch and streaming reads.

``spark.read.format("xml_archives").load(folder)`` has the rows of :func:`almsflow.sources.archives.scan_documents`. Planning lists the
folder once and opens no archive: large archives are cut by byte offset, and a member belongs to the slice its entry begins in;
small ones share a partition. Where ``partitionBytes`` would give more than ``MOST_PARTITIONS``, neighbouring slices share a partition of up to
``PARTITION_BYTES``. Tests of ``zip_name`` and ``member`` reach the listing and the archives' directories. A read with a schema
without ``xml`` inflates nothing.

``spark.readStream`` takes each archive in once. An offset is a number of entries in a log next to the stream (option
``log``): an entry names the archives that one listing found and no entry before it has, so a replayed batch reads what it read
first, and an archive that lands late with an old date is not missed. A changed archive counts as another one.
"""

from __future__ import annotations

import json
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition,
                                    StringContains, StringEndsWith, StringStartsWith)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from almsflow.operators.extract import DOCUMENT_SCHEMA, Ahead, read_member, xml_members
from almsflow.sources.files import entries, open_path, replace_file

FORMAT = "xml_archives"
PARTITION_BYTES = 128 << 20
#: Partitions from which on they grow: starting a task costs as much as reading a hundred documents.
MOST_PARTITIONS = 2_048
_BATCH_ROWS, _BATCH_CHARS = 2_000, 32_000_000


@dataclass
class _Slice(InputPartition):
    """Parts of archives: path, and which of how many slices."""

    parts: list[tuple[str, int, int, int, int]]  # path, size, first slice, the one behind the last, slices


@dataclass(frozen=True)
class _Test:
    """A pushed test of one text column."""

    column: str
    kind: str
    values: tuple[str, ...]

    def holds(self, text: str | None) -> bool:
        if text is None:
            return False
        if self.kind == "in":
            return text in self.values
        return {"starts": text.startswith, "ends": text.endswith, "contains": text.__contains__}[self.kind](self.values[0])


def _test_of(found: Filter) -> _Test | None:
    kinds = {StringStartsWith: "starts", StringEndsWith: "ends", StringContains: "contains"}
    column = found.attribute[0] if hasattr(found, "attribute") and len(found.attribute) == 1 else None
    if column not in ("zip_name", "member"):
        return None
    if isinstance(found, EqualTo) and isinstance(found.value, str):
        return _Test(column, "in", (found.value,))
    if isinstance(found, In) and all(isinstance(v, str) for v in found.value):
        return _Test(column, "in", tuple(found.value))
    return _Test(column, kinds[type(found)], (found.value,)) if type(found) in kinds else None


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _planned(archives: Sequence[tuple[str, int]], partition_bytes: int) -> list[_Slice]:
    """Partitions of about ``partition_bytes``, or more where these would be too many: slices of large archives, groups of small ones."""
    total = sum(length for _, length in archives)
    together = max(1, -(-min(total // MOST_PARTITIONS, PARTITION_BYTES) // partition_bytes))
    out, held, size = [], [], 0
    for path, length in archives:
        slices = -(-length // partition_bytes)
        if slices > together:
            out += [_Slice([(path, length, k, min(k + together, slices), slices)]) for k in range(0, slices, together)]
            continue
        held.append((path, length, 0, slices, slices))
        size += length
        if size >= together * partition_bytes:
            out.append(_Slice(held))
            held, size = [], 0
    return [*out, _Slice(held)] if held else out


def _rows(part: tuple[str, int, int, int, int], tests: Sequence[_Test], with_xml: bool) -> Iterator[dict]:
    path, size, first, stop, slices = part
    member_tests = [t for t in tests if t.column == "member"]
    try:
        with open_path(path) as source, zipfile.ZipFile(source) as archive:
            ahead = Ahead(archive, source)
            for info in xml_members(archive):
                if first <= info.header_offset * slices // size < stop and all(t.holds(info.filename) for t in member_tests):
                    xml, error = read_member(ahead, info.filename) if with_xml else (None, None)
                    yield {"zip_name": _name(path), "member": info.filename, "xml": xml, "error": error}
    except (zipfile.BadZipFile, OSError, ValueError) as problem:
        if first == 0 and not member_tests:
            yield {"zip_name": _name(path), "error": f"unreadable_archive: {problem}"}


def _batches(partition: _Slice, tests: Sequence[_Test], schema: StructType) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(schema)
    with_xml, held, chars = "xml" in arrow.names, [], 0
    for part in partition.parts:
        for row in _rows(part, tests, with_xml):
            held.append(row)
            chars += len(row.get("xml") or "")
            if len(held) >= _BATCH_ROWS or chars >= _BATCH_CHARS:
                yield pa.RecordBatch.from_pylist(held, arrow)
                held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, arrow)


class _Options:
    def __init__(self, options: dict, schema: StructType):
        self.folder, self.schema, self.tests = options["path"], schema, []
        self.pattern = options.get("pattern", "*.zip")
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.log, self.per_batch = options.get("log"), int(options.get("archivesPerBatch", 500))

    def listed(self) -> list[tuple[str, int, str]]:
        """Path, size and time of the folder's archives that hold something, by name."""
        return sorted((path, size, str(time)) for path, size, time in entries(self.folder) if size and fnmatch(_name(path), self.pattern))


class _Reader(_Options, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for found in filters:
            test = _test_of(found)
            if test is None:
                yield found
            else:
                self.tests.append(test)

    def partitions(self) -> Sequence[InputPartition]:
        names = [t for t in self.tests if t.column == "zip_name"]
        wanted = [(path, size) for path, size, _ in self.listed() if all(t.holds(_name(path)) for t in names)]
        return _planned(wanted, self.partition_bytes) or [_Slice([])]

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        return _batches(partition, self.tests, self.schema)


class _StreamReader(_Options, DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        super().__init__(options, schema)
        if not self.log:
            raise ValueError("a stream of archives needs the option 'log'")

    def _entry(self, number: int) -> list[list]:
        with open_path(f"{self.log}/{number:09d}.json") as source:
            return json.loads(source.read())

    def _entries(self) -> list[int]:
        return sorted(int(_name(path)[:-5]) for path, _, _ in entries(self.log, missing_ok=True) if path.endswith(".json") and not _name(path).startswith("_"))

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        numbers = self._entries()
        seen = {tuple(e) for n in numbers for e in self._entry(n)}
        fresh = [e for e in self.listed() if e not in seen][:self.per_batch]
        if not fresh:
            return {"entries": len(numbers)}
        with replace_file(f"{self.log}/{len(numbers) + 1:09d}.json") as out:
            out.write(json.dumps(fresh).encode())
        return {"entries": len(numbers) + 1}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        archives = [(e[0], e[1]) for n in range(start["entries"] + 1, end["entries"] + 1) for e in self._entry(n)]
        return _planned(archives, self.partition_bytes) or [_Slice([])]

    def read(self, partition: _Slice) -> Iterator[pa.RecordBatch]:
        return _batches(partition, self.tests, self.schema)


class XmlArchives(DataSource):
    """Documents of zip archives: zip_name, member, xml, error."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return DOCUMENT_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with tests pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(XmlArchives)
