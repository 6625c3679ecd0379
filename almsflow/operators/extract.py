"""XML filings to dataset rows: each document is parsed once for all datasets."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from almsflow.plans.specs import FORMS, METADATA, NAMESPACE, SPECS, Spec

DOCUMENT_SCHEMA = "zip_name string, member string, xml string, error string"
ROW_SCHEMA = ("dataset string, seq int, filing_number string, zip_name string, ein string, tax_yr string, "
              "form string, fields map<string,string>, member string, error string")

_NS = f"{{{NAMESPACE}}}"
_BATCH_ROWS, _BATCH_CHARS = 2000, 32_000_000  # what is handed to Arrow at a time
_WIDE_ROWS = 10_000  # the same of rows dealt to a batch per dataset


_FORMS_KEPT = 64  # forms whose starts are remembered, besides the known ones
_READ_AHEAD = 4 << 20  # bytes of an archive read at a time
_SMALL_RECORD = 256  # elements of a record up to which it is read in one go


class _Index:
    """Elements of a document in document order, and the places of each tag among them.

    An element's descendants are a run of places. A small record is read as a whole; in a large one the first descendant of a
    tag is found by binary search, however deep records are nested in each other.
    """

    def __init__(self, root: ET.Element):
        self.elements = list(root.iter())
        self.tags = [e.tag for e in self.elements]
        self.places: dict[str, list[int]] = {}

    def first(self, tag: str, place: int, end: int) -> ET.Element | None:
        """The first element of the tag behind ``place`` and before ``end``."""
        if not self.places:
            for at, found in enumerate(self.tags):
                self.places.setdefault(found, []).append(at)
        own = self.places.get(tag, ())
        k = bisect_right(own, place)
        return self.elements[own[k]] if k < len(own) and own[k] < end else None

    def record(self, place: int, tags: Iterable[str]) -> dict[str, str | None]:
        """Text of the first element of each tag, as far as there is one, below the element at ``place``."""
        own = list(self.elements[place].iter())
        if len(own) <= _SMALL_RECORD:
            return {e.tag: e.text for e in own[:0:-1]}
        found = ((t, self.first(t, place, place + len(own))) for t in tags)
        return {t: e.text for t, e in found if e is not None}


def _of_form(specs: Sequence[Spec], form: str) -> dict[str, list[tuple[int, Spec, tuple[str, ...], list[str]]]]:
    """By subroot tag: the specs whose records start there, with their columns and the tags of these."""
    out: dict[str, list] = {}
    for at, spec in enumerate(specs):
        out.setdefault(_NS + spec.subroots.get(form, ""), []).append(
            (at, spec, tuple(spec.fields), [_NS + by_form.get(form, "") for by_form in spec.fields.values()]))
    return out


def filing_records(zip_name: str, member: str, xml: str, specs: Sequence[Spec], forms: dict | None = None) -> tuple[dict[str, str], list[tuple]]:
    """Key of a filing and its dataset rows ``(dataset, seq, columns, texts)``. Raises ValueError when it cannot be keyed.

    ``forms`` keeps what depends on the specs and a form only, from one document to the next.
    """
    index = _Index(ET.fromstring(xml))
    key, absent = {}, []
    for column, element in METADATA.items():
        try:
            key[column] = index.elements[index.tags.index(_NS + element, 1)].text
        except ValueError:
            absent.append(column)
    if absent:
        raise ValueError(f"missing {', '.join(absent)}")
    stem = re.sub(r"(?<=.)\.[^.]*$", "", member.rsplit("/", 1)[-1])
    key |= {"filing_number": stem.split("_")[0], "zip_name": zip_name}
    form, forms = key["form"], {} if forms is None else forms
    starts = forms.get(form)
    if starts is None:
        starts = _of_form(specs, form)
        if form in FORMS or len(forms) < _FORMS_KEPT:  # others come from the documents, and may be many
            forms[form] = starts
    seqs, out = [0] * len(specs), []
    for place, root in enumerate(index.tags):
        if root not in starts or not place:  # the root is no record
            continue
        own = starts[root]
        record = index.record(place, {t for _, _, _, tags in own for t in tags})
        for at, spec, columns, tags in own:  # datasets may share a record (one form body serves two of them)
            if spec.keep_empty or not record.keys().isdisjoint(tags):
                out.append((at, spec.name, seqs[at], columns, [record.get(t) for t in tags]))
            seqs[at] += 1
    out.sort(key=itemgetter(0, 2))
    return key, [row[1:] for row in out]


def filing_rows(zip_name: str, member: str, xml: str, specs: Sequence[Spec]) -> list[dict]:
    """The dataset rows of one filing as dicts."""
    key, records = filing_records(zip_name, member, xml, specs)
    return [key | {"dataset": name, "seq": seq, "fields": dict(zip(columns, texts)), "member": member, "error": None} for name, seq, columns, texts in records]


class _Rows:
    """Dataset rows gathered column by column."""

    KEYS = ("filing_number", "zip_name", "ein", "tax_yr", "form")

    def __init__(self):
        self.columns: dict[str, list] = {c: [] for c in ("dataset", "seq", *self.KEYS, "member", "error")}
        self.offsets, self.names, self.texts, self.absent = [0], [], [], []
        self.forms: dict = {}

    def __len__(self) -> int:
        return len(self.absent)

    def add(self, zip_name: str, member: str | None, xml: str | None, error: str | None, specs: Sequence[Spec]) -> None:
        """Rows of a document, or one quarantine row saying why there are none."""
        try:
            if xml is None:
                raise ValueError(error or "no content")
            key, records = filing_records(zip_name, member, xml, specs, self.forms)
        except (ET.ParseError, ValueError) as problem:
            self.fail(zip_name, member, f"{type(problem).__name__}: {problem}")
            return
        n, held = len(records), self.columns
        for name, seq, columns, texts in records:
            held["dataset"].append(name)
            held["seq"].append(seq)
            self.names += columns
            self.texts += texts
            self.offsets.append(len(self.names))
        for c in self.KEYS:
            held[c] += [key[c]] * n
        held["member"] += [member] * n
        held["error"] += [None] * n
        self.absent += [False] * n

    def fail(self, zip_name: str, member: str | None, error: str) -> None:
        values = {"zip_name": zip_name, "member": member, "error": error}
        for c, held in self.columns.items():
            held.append(values.get(c))
        self.offsets.append(len(self.names))
        self.absent.append(True)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        # An absent map is null, which an offset array says by a null of its own.
        offsets = pa.array([None if gone else at for at, gone in zip(self.offsets, [*self.absent, False])], pa.int32())
        fields = pa.MapArray.from_arrays(offsets, pa.array(self.names, pa.string()), pa.array(self.texts, pa.string()))
        yield pa.RecordBatch.from_arrays([fields if f.name == "fields" else pa.array(self.columns[f.name], f.type) for f in schema], schema=schema)


class _WideRows(_Rows):
    """Dataset rows with a column per field, gathered by dataset, so that a batch names no field twice."""

    def __init__(self):
        self.forms: dict = {}
        self.found: dict[str | None, tuple[tuple[str, ...], list[tuple], list[Sequence[str | None]]]] = {}
        self.count = 0

    def __len__(self) -> int:
        return self.count

    def add(self, zip_name: str, member: str | None, xml: str | None, error: str | None, specs: Sequence[Spec]) -> None:
        try:
            if xml is None:
                raise ValueError(error or "no content")
            key, records = filing_records(zip_name, member, xml, specs, self.forms)
        except (ET.ParseError, ValueError) as problem:
            self.fail(zip_name, member, f"{type(problem).__name__}: {problem}")
            return
        key = tuple(key[c] for c in self.KEYS)
        for name, seq, columns, texts in records:
            self._put(name, columns, (seq, *key, member, None), texts)

    def fail(self, zip_name: str, member: str | None, error: str) -> None:
        self._put(None, (), (None, None, zip_name, None, None, None, member, error), ())

    def _put(self, name: str | None, columns: tuple[str, ...], head: tuple, texts: Sequence[str | None]) -> None:
        _, heads, values = self.found.setdefault(name, (columns, [], []))
        heads.append(head)
        values.append(texts)
        self.count += 1

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for name, (columns, heads, values) in self.found.items():
            held = dict(zip(("seq", *self.KEYS, "member", "error"), zip(*heads))) | dict(zip(columns, zip(*values)))
            held["dataset"] = [name] * len(heads)
            yield pa.RecordBatch.from_arrays([pa.array(held[f.name], f.type) if f.name in held else pa.nulls(len(heads), f.type) for f in schema], schema=schema)


def _row_batches(documents: Iterable[tuple], specs: Sequence[Spec], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Arrow batches of the rows of ``(zip_name, member, xml, error)`` documents; without a member, of a failed archive."""
    kind, most = (_Rows, _BATCH_ROWS) if "fields" in schema.names else (_WideRows, _WIDE_ROWS)
    rows, chars = kind(), 0
    for zip_name, member, xml, error in documents:
        if member is None:
            rows.fail(zip_name, None, error or "no content")
        else:
            rows.add(zip_name, member, xml, error, specs)
            chars += len(xml or "")
        if len(rows) >= most or chars >= _BATCH_CHARS:
            yield from rows.batches(schema)
            rows, chars = kind(), 0
    if len(rows):
        yield from rows.batches(schema)


def _record_batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def pack(batch: list[dict]) -> pa.RecordBatch:
        columns = []
        for f in schema:
            values = [row.get(f.name) for row in batch]
            columns.append(pa.array(values, f.type))
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    batch, chars = [], 0
    for row in rows:
        batch.append(row)
        chars += len(row.get("xml") or "")
        if len(batch) == _BATCH_ROWS or chars >= _BATCH_CHARS:
            yield pack(batch)
            batch, chars = [], 0
    if batch:
        yield pack(batch)


class Ahead:
    """Members of an archive, neighbours with one read: opening a small one by itself costs more than inflating it.

    Only plain deflated members whose header, size and checksum agree with the directory come from here; what is odd or
    damaged is left to ``zipfile``, and so are its reasons.
    """

    def __init__(self, archive: zipfile.ZipFile, source):
        self.archive, self.source, self.base, self.held, self.reached = archive, source, 0, memoryview(b""), None
        starts = sorted({i.header_offset for i in archive.infolist()})
        self.ends = dict(zip(starts, starts[1:]))  # the last member of an archive has none here

    def read(self, name: str) -> bytes:
        found = self._inflated(self.archive.getinfo(name))
        return self.archive.read(name) if found is None else found

    def _inflated(self, info: zipfile.ZipInfo) -> bytes | None:
        at, end = info.header_offset, self.ends.get(info.header_offset)
        if info.compress_type != zipfile.ZIP_DEFLATED or info.flag_bits & 0x61 or end is None or end - at > _READ_AHEAD:
            return None
        if at < self.base or end > self.base + len(self.held):
            # Whoever jumps about in an archive gets no more than the member.
            in_order = self.reached is not None and 0 <= at - self.reached <= _READ_AHEAD
            self.source.seek(at)
            self.base, self.held = at, memoryview(self.source.read(_READ_AHEAD if in_order else end - at))
        self.reached = end
        entry = self.held[at - self.base:end - self.base]
        if len(entry) < 30 or entry[:4] != b"PK\3\4":
            return None
        flags, name_size, extra_size = (int.from_bytes(entry[k:k + 2], "little") for k in (6, 26, 28))
        first = 30 + name_size + extra_size
        stop = first + info.compress_size
        if flags != info.flag_bits or entry[30:30 + name_size] != info.orig_filename.encode("utf-8") or stop > len(entry):
            return None
        stream = zlib.decompressobj(-zlib.MAX_WBITS)
        try:
            text = stream.decompress(entry[first:stop], info.file_size + 1)
        except zlib.error:
            return None
        whole = stream.eof and not stream.unused_data and len(text) == info.file_size and zlib.crc32(text) == info.CRC
        return text if whole else None


def read_member(archive: zipfile.ZipFile | Ahead, name: str) -> tuple[str | None, str | None]:
    """Text of one member with undecodable bytes dropped, or a reason it cannot be read."""
    try:
        return archive.read(name).decode("utf-8", errors="ignore"), None
    except NotImplementedError as problem:
        return None, f"unsupported_compression: {problem}"
    except (zipfile.BadZipFile, zlib.error, RuntimeError, EOFError, KeyError) as problem:
        return None, f"unreadable_member: {problem}"


def xml_members(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    return [i for i in archive.infolist() if i.filename.endswith(".xml")]


def archive_documents(zip_name: str, source, members: Sequence[str] | None = None) -> Iterator[dict]:
    """Documents of an open archive; an unreadable archive is one error row."""
    try:
        with zipfile.ZipFile(source) as archive:
            names = members if members is not None else [i.filename for i in xml_members(archive)]
            ahead = Ahead(archive, source)
            for name in names:
                xml, error = read_member(ahead, name)
                yield {"zip_name": zip_name, "member": name, "xml": xml, "error": error}
    except (zipfile.BadZipFile, OSError, ValueError) as problem:
        yield {"zip_name": zip_name, "member": None, "xml": None, "error": f"unreadable_archive: {problem}"}


def in_batches(make: Callable[[dict], Iterable[dict]], schema: str):
    """A ``mapInArrow`` function from a row -> rows generator."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for record in batch.to_pylist() for row in make(record))
        yield from _record_batches(rows, arrow)

    return run


def documents(archives: DataFrame) -> DataFrame:
    """One row per XML member of ``(path, content)`` archives."""
    def members(row: dict) -> Iterator[dict]:
        yield from archive_documents(row["path"].rsplit("/", 1)[-1], io.BytesIO(row["content"]))

    return archives.select("path", "content").mapInArrow(in_batches(members, DOCUMENT_SCHEMA), DOCUMENT_SCHEMA)


def extract(docs: DataFrame, specs: Sequence[Spec] = SPECS) -> DataFrame:
    """Dataset rows of every document, plus a row with ``error`` set for each
    document that could not be read. Other documents are unaffected."""
    specs = tuple(specs)

    schema = to_arrow_schema(T.StructType.fromDDL(ROW_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _row_batches((d for b in batches for d in zip(*(b.column(c).to_pylist() for c in ("zip_name", "member", "xml", "error")))), specs, schema)

    return docs.select("zip_name", "member", "xml", "error").mapInArrow(run, ROW_SCHEMA)


def wide_schema(specs: Sequence[Spec]) -> T.StructType:
    """Extracted rows with a column per field of the specs in place of the map."""
    head = [f for f in T.StructType.fromDDL(ROW_SCHEMA) if f.name != "fields"]
    return T.StructType([*head, *[T.StructField(c, T.StringType()) for c in dict.fromkeys(f for s in specs for f in s.fields)]])


def extract_members(chunks: DataFrame, open_archive: Callable[[str], object], specs: Sequence[Spec] = SPECS, wide: bool = False) -> DataFrame:
    """Like :func:`extract`, reading ``(path, members, error)`` chunks straight from
    storage, so document text never passes through the JVM. A chunk with an error becomes one error row.
    ``wide`` gives a column per field, as they are written."""
    specs = tuple(specs)

    rows = wide_schema(specs) if wide else T.StructType.fromDDL(ROW_SCHEMA)
    schema = to_arrow_schema(rows)

    def documents_of(path: str, members: Sequence[str] | None, error: str | None) -> Iterator[tuple]:
        zip_name = path.rsplit("/", 1)[-1]
        if error:
            yield zip_name, None, None, error
            return
        try:
            source = open_archive(path)
        except OSError as problem:
            yield zip_name, None, None, f"unreadable_archive: {problem}"
            return
        with source:
            for doc in archive_documents(zip_name, source, list(members)):
                yield doc["zip_name"], doc["member"], doc["xml"], doc["error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunked = (c for b in batches for c in zip(*(b.column(x).to_pylist() for x in ("path", "members", "error"))))
        return _row_batches((d for c in chunked for d in documents_of(*c)), specs, schema)

    return chunks.select("path", "members", "error").mapInArrow(run, rows)


def extract_contents(archives: DataFrame, specs: Sequence[Spec] = SPECS) -> DataFrame:
    """Like ``extract(documents(archives))`` in one pass over ``(path, content)`` archives: one archive's documents at a time
    are held, and their text never passes through the JVM."""
    specs = tuple(specs)

    schema = to_arrow_schema(T.StructType.fromDDL(ROW_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archived = ((b.column("path")[i].as_py(), b.column("content")[i].as_py()) for b in batches for i in range(b.num_rows))
        found = (doc for path, content in archived for doc in archive_documents(path.rsplit("/", 1)[-1], io.BytesIO(content)))
        yield from _row_batches(((d["zip_name"], d["member"], d["xml"], d["error"]) for d in found), specs, schema)

    return archives.select("path", "content").mapInArrow(run, ROW_SCHEMA)


def quarantined(extracted: DataFrame) -> DataFrame:
    return extracted.filter("error IS NOT NULL").select("zip_name", "member", "error")


def dataset(extracted: DataFrame, spec: Spec, schema: T.StructType | None = None, strict: bool = False) -> DataFrame:
    """The rows of one dataset with its columns, as strings or cast to ``schema``.

    With a schema, the tokens a CSV reader treats as missing become null, and
    rows whose filing key the types cannot hold are left to :func:`bad_keys`.
    """
    from almsflow.functions.columns import cast_to
    from almsflow.functions.text import na_to_null
    from almsflow.schemas import FILING_KEY

    rows = extracted.filter(F.col("dataset") == spec.name)
    # Written rows have a column per field, rows straight from extraction a map.
    field = {c: F.col("fields")[c] if "fields" in extracted.columns else F.col(c) for c in spec.fields}
    if schema is None:
        return rows.select(*FILING_KEY, *[f.alias(c) for c, f in field.items()])
    kept = rows.filter(_whole_key(schema)).select(*FILING_KEY, *[na_to_null(f).alias(c) for c, f in field.items()])
    return cast_to(kept, schema, strict)


def _whole_key(schema: T.StructType) -> Column:
    """The identifying parts of the filing key are there and fit their types."""
    from almsflow.functions.text import na_to_null

    fits = [na_to_null(F.col(c).cast("string")).try_cast(schema[c].dataType).isNotNull() for c in ("filing_number", "ein", "tax_yr")]
    return reduce(lambda a, b: a & b, fits)


def bad_keys(extracted: DataFrame, spec: Spec, schema: T.StructType) -> DataFrame:
    """Rows of one dataset that :func:`dataset` leaves out, with the reason, like :func:`quarantined`."""
    from almsflow.schemas import FILING_KEY

    key = F.to_json(F.struct(*FILING_KEY))
    return (extracted.filter((F.col("dataset") == spec.name) & ~_whole_key(schema))
            .select("zip_name", "member", F.concat(F.lit(f"bad_key: {spec.name} "), key).alias("error")))
