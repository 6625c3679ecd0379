"""Large CSV files read in parallel byte ranges, although quoted fields may hold line breaks.

Whether a line break ends a record depends on everything before it. Each range is therefore scanned once
for every state in which the bytes before it may leave a parser; where it leads to from each state is a
small table. Running through these tables in order gives every range its true state, and with it the
place where its first record begins. Then each range parses the records that begin in it, to the end of the last one.

States: at the start of a record, at the start of a field, in an unquoted field, in a quoted field, and just behind a
quote in a quoted field (which closes it, or is the first of two that stand for one).
"""

from __future__ import annotations

import csv
import io
import math
import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from almsflow.sources.files import landed, listing, open_path

RANGE_BYTES = 16 << 20
#: Records turned into one Arrow batch, and parsing tasks per slot of the cluster at most, and at least where there are that many ranges.
BATCH, TASKS_PER_SLOT, TASKS_AT_LEAST = 4_096, 64, 4
RECORD, FIELD, PLAIN, QUOTED, AFTER = range(5)
_BOM = b"\xef\xbb\xbf"
#: The rest of a quoted field with its closing quote, if that comes; and a quoted field where one can open.
_REST = re.compile(rb'(?:[^"]+|"")*+(")?')
_OPENED = re.compile(rb'(?<=[,\r\n])"(?:[^"]+|"")*+(")?')
_SCAN = "path string, first long, size long, ends array<int>, borders array<long>"
_REGION = "path string, first long, stop long"


def scan(raw: bytes, state: int) -> tuple[int, int]:
    """The state behind these bytes, and the place behind their first line break outside quotes (-1: none)."""
    at, spans, closed = 0, [], True
    if state == AFTER:
        at, state = (1, QUOTED) if raw[:1] == b'"' else (0, PLAIN)
    elif state in (RECORD, FIELD) and raw[:1] == b'"':
        at, state = 1, QUOTED
    if state == QUOTED:
        rest = _REST.match(raw, at)
        at, closed = rest.end(), rest.group(1) is not None
        spans.append((0, at))
    if closed:
        for field in _OPENED.finditer(raw, at):
            spans.append(field.span())
            closed = field.group(1) is not None
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
    if spans:
        opens, ends = (np.array(x) for x in zip(*spans))
        before = np.searchsorted(opens, breaks, side="right") - 1
        breaks = breaks[(before < 0) | (breaks >= ends[np.maximum(before, 0)])]
    border = int(breaks[0]) + 1 if len(breaks) else -1
    if spans and spans[-1][1] == len(raw):
        return AFTER if closed else QUOTED, border
    last = raw[-1:]
    return RECORD if last == b"\n" else FIELD if last in (b",", b"\r") else PLAIN, border


def scan_all(raw: bytes) -> tuple[list[int], list[int]]:
    """``scan`` from every state; equal ones are done once."""
    outside, inside = scan(raw, PLAIN), scan(raw, QUOTED)
    opening = raw[:1] == b'"'
    at_start = scan(raw, FIELD) if opening else outside
    found = [at_start, at_start, outside, inside, scan(raw, AFTER) if opening else outside]
    return [f[0] for f in found], [f[1] for f in found]


def _read(path: str, first: int, stop: int) -> bytes:
    with open_path(path) as source:
        source.seek(first)
        return source.read(stop - first)


def _scan_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("first", pa.int64()), ("size", pa.int64()), ("ends", pa.list_(pa.int32())), ("borders", pa.list_(pa.int64()))])
    for batch in batches:
        for path, first, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "stop"))):
            raw = _read(path, first, stop)
            skipped = len(_BOM) if first == 0 and raw.startswith(_BOM) else 0
            ends, borders = scan_all(raw[skipped:])
            borders = [b if b < 0 else first + skipped + b for b in borders]
            yield pa.RecordBatch.from_pylist([{"path": path, "first": first, "size": len(raw), "ends": ends, "borders": borders}], schema)


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ranges in order: where the records that begin in a range begin and end."""
    schema = pa.schema([("path", pa.string()), ("first", pa.int64()), ("stop", pa.int64())])
    path, state, begin, end = None, RECORD, None, 0
    for batch in batches:
        out = []
        for now, first, size, ends, borders in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "size", "ends", "borders"))):
            if now != path:
                if begin is not None:
                    out.append({"path": path, "first": begin, "stop": end})
                path, state, begin = now, RECORD, None
            start = first if state == RECORD else borders[state]
            end = first + size
            if 0 <= start < end:
                if begin is not None:
                    out.append({"path": path, "first": begin, "stop": start})
                begin = start
            state = ends[state]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if begin is not None:
        yield pa.RecordBatch.from_pylist([{"path": path, "first": begin, "stop": end}], schema)


def regions(spark: SparkSession, directory: str, pattern: str = "*.csv", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(path, first, stop)``: the non-empty files of a folder, cut between records into pieces of about ``range_bytes``."""
    files = landed(listing(spark, directory, pattern))
    count, total, longest = files.agg(F.sum(F.ceil(F.col("length") / range_bytes)), F.sum("length"), F.max("length")).first()
    # Explicit widths: the rows are tiny, the reading behind them is not.
    width = _width(spark, count or 0, total or 0, range_bytes)
    # A file of one range begins with a record and ends with one, whatever it holds.
    whole = files.filter(F.col("length") <= range_bytes).select("path", F.lit(0).cast("long").alias("first"), F.col("length").alias("stop"))
    if (longest or 0) <= range_bytes:
        return whole.repartition(width, "path")
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("first")
    ranges = (files.filter(F.col("length") > range_bytes).select("path", "length", first)
              .select("path", "first", F.least(F.col("first") + range_bytes, "length").alias("stop")))
    scanned = ranges.repartition(width, "path", "first").mapInArrow(_scan_ranges, _SCAN)
    # One narrow row per range; a file's ranges meet to be run through in order.
    found = scanned.repartition(width, "path").sortWithinPartitions("path", "first").mapInArrow(_regions, _REGION)
    return found.unionByName(whole).repartition(width, "path", "first")


def _width(spark: SparkSession, ranges: int, total: int, range_bytes: int) -> int:
    """Reading tasks: enough for the bytes and for the slots, and no more for many small files, of which a task reads several."""
    slots = spark.sparkContext.defaultParallelism
    return int(min(max(1, ranges), max(TASKS_AT_LEAST * slots, math.ceil(total / range_bytes)), TASKS_PER_SLOT * slots))


def header_of(path: str) -> tuple[list[str] | None, int]:
    """The first record that is not blank, whatever its length, and where it ends; None for a file without one."""
    csv.field_size_limit(sys.maxsize)
    with open_path(path) as source:
        end = len(_BOM) if source.read(len(_BOM)) == _BOM else 0
        source.seek(end)
        # Read as Latin-1, where a character is a byte, so that places can be counted.
        lines = _Lines(io.TextIOWrapper(source, "latin-1", newline=""))
        for record in csv.reader(lines):
            end += len(lines.take())
            if any(c.strip() for c in record):
                return [c.encode("latin-1").decode("utf-8", "replace") for c in record], end
    return None, end


class _Lines:
    """Lines of a text, remembered until they are taken."""

    def __init__(self, text: io.TextIOBase):
        self.lines, self.taken = text, []

    def __iter__(self) -> _Lines:
        return self

    def __next__(self) -> str:
        line = next(self.lines)
        self.taken.append(line)
        return line

    def take(self) -> str:
        out = "".join(self.taken)
        self.taken.clear()
        return out


def records(spark: SparkSession, directory: str, columns: Sequence[str], pattern: str = "*.csv", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``columns`` as text, found by header name (null in files without them), with ``_corrupt`` and ``_file``, ``_first``, ``_row``.

    ``_corrupt`` is the text of a record that has another number of fields than its header, or ``no header``
    for a file without any. A record's place in the folder is (_file, _first, _row).
    """
    columns = list(columns)
    names = [*columns, "_corrupt", "_file", "_first", "_row"]
    kinds = [*[pa.string()] * (len(columns) + 2), pa.int64(), pa.int64()]

    def batch_of(good: list[list[str]], rows: list[int], bad: list[tuple[int, str]], where: dict[str, int], path: str, first: int) -> pa.RecordBatch:
        by_place = list(zip(*good))
        values = [list(by_place[where[c]]) if good and c in where else [None] * len(good) for c in columns]
        values = [v + [None] * len(bad) for v in values]
        n = len(good) + len(bad)
        place = [[None] * len(good) + [text for _, text in bad], [path] * n, [first] * n, rows + [r for r, _ in bad]]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip([*values, *place], kinds)], names=names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        path, header, header_end, where = None, None, 0, {}
        for batch in batches:
            for now, first, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "first", "stop"))):
                if now != path:
                    path, (header, header_end) = now, header_of(now)
                    where = {c: k for k, c in reversed(list(enumerate(header or ())))}
                if header is None:
                    if first == 0:
                        yield batch_of([], [], [(0, "no header")], {}, path, first)
                    continue
                lines = _Lines(io.StringIO(_read(path, first, stop).decode("utf-8-sig" if first == 0 else "utf-8", "replace"), newline=""))
                before, good, rows, bad = first < header_end, [], [], []
                for number, record in enumerate(csv.reader(lines)):
                    text = lines.take().rstrip("\r\n")
                    if not any(c.strip() for c in record) and len(record) < 2:
                        continue
                    if before and any(c.strip() for c in record):
                        before = False
                        continue
                    if len(record) == len(header):
                        good.append(record)
                        rows.append(number)
                    else:
                        bad.append((number, text))
                    if len(good) + len(bad) == BATCH:
                        yield batch_of(good, rows, bad, where, path, first)
                        good, rows, bad = [], [], []
                if good or bad:
                    yield batch_of(good, rows, bad, where, path, first)

    schema = ", ".join([*(f"`{c}` string" for c in columns), "_corrupt string, _file string, _first long, _row long"])
    return regions(spark, directory, pattern, range_bytes).mapInArrow(parse, schema)
