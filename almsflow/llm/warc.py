"""WARC archives: written as whole-file gzip streams, normalised to a gzip member per record, read by offset.

1. ``write_archives`` makes one record of every page. Spark's text writer compresses each task's records as
   one gzip stream: the form in which many tools ship archives, readable only from the start.
2. ``normalise`` inflates every such file once, from beginning to end, and rewrites each record as a gzip member of its
   own. A sidecar of JSON lines next to the archive has offset, length and identity of every member.
   Records pass in pieces of ``PIECE`` bytes, so neither files nor records have to fit into memory; a file is the
   unit of work, since a gzip stream cannot be entered in the middle.
3. ``read_records`` needs only the sidecars: they are dealt by archive and ``RANGE`` of offsets, so an archive of any
   size is read by many tasks, each from its own members.

Of pages with equal payloads of ``min_bytes`` or more, the one with the largest page_id becomes ``response``; the
others are ``revisit`` records (profile identical-payload-digest) that refer to it and carry no payload.

Defined cases: null html is an empty payload; a null page_id is smaller than any and comes back as null; of
rows that repeat both page_id and payload one is the response; a null url has no target line, line
breaks in one are percent-encoded; an empty table gives no archives and an empty result; other columns may
have any name and are not written. Of a file that is damaged or no WARC, the records before the damage are kept, and its
manifest row says what was wrong.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from almsflow.runtime import cut_lineage, fresh_path
from almsflow.sources.files import listing, open_path, replace_file

MIN_BYTES = 1_000
PIECE = 1 << 18
#: Bytes of an archive that one reading group takes, and of neighbouring members that one read fetches.
RANGE, RUN = 64 << 20, 4 << 20
#: A record's header block may not be longer.
HEADER_LIMIT = 1 << 20
LEVEL = 6
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

_INDEX = "archive string, offset long, length long, type string, id string, page string, digest string"
_RECORD = "type string, id string, page string, url string, refers_to string, payload_bytes long, payload_digest string, valid boolean"
_MANIFEST = "source string, archive string, records long, error string"


# Writing

def _urn(digest) -> object:
    """A record identifier that a digest decides."""
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-8"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def _judged(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Pages with payload, digest and ``owner``: null, or the page that holds the payload; ``first`` marks that page."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").alias("page"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"n": F.octet_length("payload").cast("long"), "digest": F.sha1("payload"), "check": F.xxhash64("payload")})
    key = ["digest", "check", "n"]
    # Counted per page first, so that a payload of very many pages is summed before it meets in one place.
    per_page = rows.where(F.col("n") >= min_bytes).groupBy(*key, "page").agg(F.count(F.lit(1)).alias("copies"))
    largest = F.max(F.struct(F.col("page").isNotNull(), F.col("page"), F.col("copies")))
    shared = (per_page.groupBy(*key).agg(F.sum("copies").alias("rows"), largest.alias("top")).where("rows > 1")
              .select(*key, F.struct(F.col("top.page").alias("page")).alias("owner"), F.col("top.copies").alias("owner_copies")))
    shared = cut_lineage(shared)
    judged = rows.join(shared, key, "left")
    is_owner = F.col("owner").isNotNull() & F.col("page").eqNullSafe(F.col("owner.page"))
    judged = judged.withColumn("first", F.col("owner").isNull() | is_owner)
    if shared.where("owner_copies > 1").isEmpty():
        return judged.drop("owner_copies")
    # Rows that repeat page_id and payload: only these are numbered.
    again = F.coalesce(is_owner & (F.col("owner_copies") > 1), F.lit(False))
    turn = F.row_number().over(Window.partitionBy("digest", "check", "n").orderBy("url"))
    return judged.where(~again).union(judged.where(again).withColumn("first", turn == 1)).drop("owner_copies")


def records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """One column ``record``: the whole WARC record of each page, without the line breaks that end it."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    shared, revisit = F.col("owner").isNotNull(), ~F.col("first")
    holder = _urn(F.sha1(F.concat_ws("/", F.lit("response"), "digest", F.col("check").cast("string"), F.col("n").cast("string"))))
    own = F.when(shared & ~revisit, holder).otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", own),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", url), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(REVISIT))), line("WARC-Refers-To", F.when(revisit, holder)), line("X-Page-Id", F.col("page").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"), line("Content-Length", length.cast("string")), F.lit("\r\n"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    return _judged(pages, min_bytes).select(F.concat(head, http, body).alias("record"))


def write_archives(pages: DataFrame, directory: str, min_bytes: int = MIN_BYTES) -> None:
    """One archive a task, each a single gzip stream."""
    records(pages, min_bytes).write.option("lineSep", END).option("compression", "gzip").text(directory)


# Normalising

class Inflated:
    """The inflated bytes of a gzip file, read once from beginning to end; members may follow each other."""

    def __init__(self, source):
        self.source, self.inflate, self.held, self.input = source, zlib.decompressobj(31), bytearray(), b""
        self.inside = False

    def _more(self) -> bool:
        """Inflate a bounded piece; False at the end of the file."""
        while True:
            if self.inflate.eof:
                self.input, self.inflate, self.inside = self.inflate.unused_data, zlib.decompressobj(31), False
            if not self.input:
                self.input = self.source.read(PIECE)
                if not self.input:
                    if self.inside:
                        raise ValueError("gzip stream ends early")
                    return False
            self.inside = True
            piece = self.inflate.decompress(self.input, PIECE)
            self.input = self.inflate.unconsumed_tail
            if piece:
                self.held += piece
                return True

    def skip_breaks(self) -> bool:
        """Go to the next record; False at the end of the file."""
        while True:
            del self.held[:len(self.held) - len(self.held.lstrip(b"\r\n"))]
            if self.held:
                return True
            if not self._more():
                return False

    def up_to(self, mark: bytes, limit: int) -> bytes:
        """What stands before and including the mark."""
        looked = 0
        while (at := self.held.find(mark, max(0, looked - len(mark)))) < 0:
            looked = len(self.held)
            if looked > limit:
                raise ValueError("header block too long")
            if not self._more():
                raise ValueError("file ends inside a record")
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self._more():
                raise ValueError("file ends inside a record")
            piece = self.take(min(n, len(self.held)))
            n -= len(piece)
            yield piece


def fields(block: bytes) -> dict[str, str]:
    """The named fields of a header block, names in lower case."""
    found = {}
    for row in block.split(b"\r\n")[1:]:
        name, colon, value = row.partition(b":")
        if colon:
            found[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return found


def normalise(spark: SparkSession, directory: str, out: str) -> DataFrame:
    """Rewrite all archives below ``directory`` into ``out``; returns the manifest, a row per source file.

    ``out/archives`` gets the archives, ``out/index`` their sidecars, ``out/manifest`` the manifest.
    """
    files = listing(spark, directory, "*.gz").select("path")

    def rewrite(path: str) -> dict:
        name = path.rsplit("/", 1)[-1].split(".")[0] + "-" + hashlib.sha1(path.encode()).hexdigest()[:8] + ".warc.gz"
        count, error = 0, None
        with open_path(path) as source, replace_file(f"{out}/archives/{name}") as archive, replace_file(f"{out}/index/{name}.jsonl") as index:
            stream, offset = Inflated(source), 0
            try:
                while stream.skip_breaks():
                    head = stream.up_to(END.encode(), HEADER_LIMIT)
                    named = fields(head)
                    if not head.startswith(b"WARC/") or not named.get("content-length", "").isdigit():
                        raise ValueError("not a WARC record")
                    # Held compressed until it is whole, so that damage never leaves half a member behind.
                    member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    packed = bytearray(member.compress(head))
                    for piece in stream.pieces(int(named["content-length"])):
                        packed += member.compress(piece)
                    packed += member.compress(END.encode()) + member.flush()
                    archive.write(packed)
                    entry = {"archive": name, "offset": offset, "length": len(packed), "type": named.get("warc-type"), "id": named.get("warc-record-id"),
                             "page": named.get("x-page-id"), "digest": named.get("warc-payload-digest")}
                    index.write(json.dumps(entry).encode() + b"\n")
                    offset, count = offset + len(packed), count + 1
            except (ValueError, zlib.error, EOFError) as problem:
                error = f"after {count} records: {problem}"
        return {"source": path, "archive": name, "records": count, "error": error}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield pa.RecordBatch.from_pylist([rewrite(path)], pa.schema([("source", pa.string()), ("archive", pa.string()), ("records", pa.int64()), ("error", pa.string())]))

    # A task a file, as far as there are slots; the number is explicit, because the paths alone look small.
    width = min(max(1, files.count()), 16 * spark.sparkContext.defaultParallelism)
    files.repartition(width, "path").mapInArrow(run, _MANIFEST).write.parquet(f"{out}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{out}/manifest")


# Reading

def index(spark: SparkSession, out: str) -> DataFrame:
    """``(archive, offset, length, type, id, page, digest)`` of every record, from the sidecars."""
    written = spark.read.schema(_MANIFEST).parquet(f"{out}/manifest")
    if written.isEmpty():
        return spark.createDataFrame([], _INDEX)
    return spark.read.schema(_INDEX).json(f"{out}/index")


def _same_digest(named: str | None, payload: bytes) -> bool | None:
    """Whether a labelled SHA-1, hexadecimal or Base32, is the payload's; None without one."""
    if not named or not named.lower().startswith("sha1:"):
        return None
    digest, value = hashlib.sha1(payload), named[5:].strip()
    return value.lower() == digest.hexdigest() or value.upper() == base64.b32encode(digest.digest()).decode()


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and payload of one gzip member. The payload of an HTTP message begins behind its header."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(END.encode())
    named = fields(head)
    block = rest[:int(named.get("content-length", 0))]
    if named.get("content-type", "").lower().startswith("application/http"):
        block = block.partition(END.encode())[2]
    return named, block


def read_records(spark: SparkSession, out: str, payload: bool = True) -> DataFrame:
    """Every record of the normalised archives: type, id, page, url, refers_to, payload_bytes, payload_digest, valid,
    and with ``payload`` the bytes themselves. ``valid`` compares the payload of a response with its named digest."""
    schema = _RECORD + (", payload binary" if payload else "")
    names = [c.split()[0] for c in schema.split(", ")]
    held = index(spark, out).select("archive", "offset", "length", F.floor(F.col("offset") / RANGE).alias("range"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
        """Neighbouring members of one archive, up to ``RUN`` bytes or one member."""
        archive, run, size = None, [], 0
        for batch in batches:
            for path, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
                if run and (path != archive or offset != run[-1][0] + run[-1][1] or size + length > RUN):
                    yield archive, run
                    run, size = [], 0
                archive, size = path, size + length
                run.append((offset, length))
        if run:
            yield archive, run

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = opened = None
        try:
            for archive, run in runs(batches):
                if archive != opened:
                    if source:
                        source.close()
                    source, opened = open_path(f"{out}/archives/{archive}"), archive
                begin = run[0][0]
                source.seek(begin)
                raw, rows = source.read(run[-1][0] + run[-1][1] - begin), []
                for offset, length in run:
                    named, body = parsed(raw[offset - begin:offset - begin + length])
                    kind = named.get("warc-type")
                    rows.append({"type": kind, "id": named.get("warc-record-id"), "page": named.get("x-page-id"), "url": named.get("warc-target-uri"),
                                 "refers_to": named.get("warc-refers-to"), "payload_bytes": len(body), "payload_digest": hashlib.sha1(body).hexdigest(),
                                 "valid": _same_digest(named.get("warc-payload-digest"), body) if kind == "response" else None, "payload": body})
                columns = [[r[c] for r in rows] for c in names]
                kinds = {"payload_bytes": pa.int64(), "valid": pa.bool_(), "payload": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.string())) for c, v in zip(names, columns)], names=names)
        finally:
            if source:
                source.close()

    # Dealt by archive and range; the entries alone look small, the members behind them are not.
    total = held.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    width = min(max(2 * spark.sparkContext.defaultParallelism, -(-total // RANGE)), 16 * spark.sparkContext.defaultParallelism)
    return held.repartition(width, "archive", "range").sortWithinPartitions("archive", "offset").mapInArrow(read, schema)


def resolved(found: DataFrame) -> DataFrame:
    """Responses and revisits as (page, url, payload_bytes, payload_digest, type, refers_to, valid), where a revisit
    has the payload's numbers and the page of the response it refers to."""
    found = cut_lineage(found.where(F.col("type").isin("response", "revisit")))
    columns = ["page", "url", "payload_bytes", "payload_digest", "type"]
    own = found.where("type = 'response'")
    back = own.select(F.col("id").alias("refers_to"), F.col("page").alias("holder"), F.col("payload_bytes").alias("n"), F.col("payload_digest").alias("digest"), "valid")
    revisits = (found.where("type = 'revisit'").select("page", "url", "type", "refers_to").join(back, "refers_to", "left")
                .select("page", "url", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "type", F.col("holder").alias("refers_to"), "valid"))
    return own.select(*columns, F.lit(None).cast("string").alias("refers_to"), "valid").union(revisits)


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the pages as archives, normalise these, and return what stands in them, a row per page."""
    spark, path = pages.sparkSession, fresh_path(pages.sparkSession, "warc")
    write_archives(pages, f"{path}/streams", min_bytes)
    normalise(spark, f"{path}/streams", f"{path}/records")
    return resolved(read_records(spark, f"{path}/records", payload=False))
