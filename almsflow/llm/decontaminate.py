"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items become windows of 13 consecutive normalised words (a shorter item is one
window). All windows together form one automaton; every document is normalised once and
scanned once, and the found windows are mapped back to word numbers and to code point
offsets of the original text.

The automaton must fit a task, so its windows are bounded: ``max_words`` benchmark words per
automaton. A larger benchmark is dealt into parts by item hash, and the documents pass the
parts one after the other, each pass reading what the one before wrote to the shared folder;
the words found by all parts are merged before anything is decided. Nothing is left out.

Defined cases: null text has no words; items with null or wordless text have no windows; an
item without identifier takes part under the name ``null``; equal items count under each of
their identifiers; repeated documents are judged row by row; extra columns are carried or
left out by ``carry`` and may have any name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from almsflow.llm.tables import kept, utf8
from almsflow.runtime import cut_lineage

WINDOW = 13
#: Benchmark words of one automaton: about 80 bytes a character node, some 200 MB at most.
MAX_WORDS = 30_000
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType()),
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
])
_FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
    ("spans", pa.list_(pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()),
                                  ("start", pa.int32()), ("end", pa.int32())]))),
])


def _normal_table() -> bytes:
    table = bytearray(b" " * 128) + bytearray(range(128, 256))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        table[c] = c
    for c in range(65, 91):
        table[c] = c + 32
    return bytes(table)


_NORMAL = _normal_table()


def normal_words(raw: bytes) -> list[bytes]:
    return raw.translate(_NORMAL).split()


def windows(item_words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All windows of an item; a shorter one is a window as it stands, an empty one has none."""
    if not item_words:
        return []
    size = min(size, len(item_words))
    return [tuple(item_words[i:i + size]) for i in range(len(item_words) - size + 1)]


class Matcher:
    """The automaton over ``" word word ... "`` and what each window belongs to."""

    def __init__(self, items: list[tuple[str, bytes]]):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for name, raw in items:
            for window in windows(normal_words(raw)):
                owners.setdefault(window, set()).add(name)
        self.automaton = ahocorasick.Automaton()
        for window, names in owners.items():
            key = (b" " + b" ".join(window) + b" ").decode("latin-1")
            self.automaton.add_word(key, (len(window), names))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def find(self, found_words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Which words are hit (None: none) and the items found."""
        if self.empty or not found_words:
            return None, set()
        text = b" " + b" ".join(found_words) + b" "
        ends, names = [], set()
        for end, (length, owners) in self.automaton.iter(text.decode("latin-1")):
            ends.append((end, length))
            names |= owners
        if not ends:
            return None, names
        blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        at, length = np.array(ends).T
        stop = np.searchsorted(blanks, at)
        edge = np.zeros(len(found_words) + 1, np.int32)
        np.add.at(edge, stop - length, 1)
        np.add.at(edge, stop, -1)
        return np.cumsum(edge[:-1]) > 0, names


def _word_offsets(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code point offsets of the start and the end of every normalised word."""
    inside = np.frombuffer(raw.translate(_NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return points[np.flatnonzero(edge == 1)], points[np.flatnonzero(edge == -1)]


def _judge(raw: bytes, matcher: Matcher, before: dict | None) -> dict:
    found_words = normal_words(raw)
    hit, names = matcher.find(found_words)
    if before:
        names = names | set(before["items"])
        if before["spans"]:
            hit = np.zeros(len(found_words), bool) if hit is None else hit
            for s in before["spans"]:
                hit[s["first_word"]:s["end_word"]] = True
    spans = []
    if hit is not None:
        starts, ends = _word_offsets(raw)
        edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            spans.append({"first_word": a, "end_word": b, "start": int(starts[a]), "end": int(ends[b - 1])})
    return {"n_words": len(found_words), "n_hit": 0 if hit is None else int(hit.sum()), "items": sorted(names), "spans": spans}


def _parts(benchmark: DataFrame, max_words: int) -> Iterator[tuple[bool, list[tuple[str, bytes]]]]:
    """The items of each automaton, one part after the other, and whether it is the last; ``max_words`` bounds a part."""
    sized = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text",
                             F.regexp_count("text", F.lit(_WORD)).alias("n")).where(F.col("text").isNotNull())
    total = sized.agg(F.sum("n")).first()[0] or 0
    n = -(-total // max_words) if total > max_words else 1
    for part in range(n):
        own = sized if n == 1 else sized.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == part)
        yield part == n - 1, [(r["item"], r["text"].encode()) for r in own.select("item", "text").collect()]


def _found(shared: Broadcast, text, before):
    """The column of what one automaton finds in ``text``, joined to what earlier ones found.

    Only texts go to Python and only findings come back; the other columns stay where they are.
    """
    key = uuid.uuid4().hex

    def judge(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        matcher = kept(key, lambda: Matcher(shared.value))
        for texts, earlier in batches:
            yield pa.array([_judge(raw, matcher, b) for raw, b in zip(utf8(texts), earlier.to_pylist())], _FOUND_ARROW)

    # Else the optimizer runs it again in filters on its result.
    return F.arrow_udf(judge, FOUND).asNondeterministic()(text, before)


def scan(docs: DataFrame, benchmark: DataFrame, carry: list[str], into: str, text_col: str = "text",
         max_words: int = MAX_WORDS) -> DataFrame:
    """``carry`` columns of every document plus struct ``into``: words, hit words, items, spans.

    ``spans`` holds runs of hit words, as word numbers and as code point offsets of the text.
    """
    out, carried = docs, list(dict.fromkeys(carry))
    before = F.lit(None).cast(FOUND)
    for last, items in _parts(benchmark, max_words):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        columns = carried if last else list(dict.fromkeys([*carried, text_col]))
        out = out.select(*[F.col(f"`{c}`") for c in columns], _found(shared, F.col(f"`{text_col}`"), before).alias(into))
        if not last:
            out, before = cut_lineage(out), F.col(f"`{into}`")
            shared.unpersist()  # one part is alive at a time
    return out


def contaminated(found: str, share: int = 20):
    """At least one hit word, and hit words are 1/share of all words or more."""
    return (F.col(f"{found}.n_hit") > 0) & (F.col(f"{found}.n_hit") * share >= F.col(f"{found}.n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """Per document: words, hit words, found items, their digest, the verdict, and the hit spans."""
    found = scan(docs, benchmark, ["doc_id"], "found", max_words=max_words)
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated("found").alias("contaminated"), F.col("found.spans").alias("spans"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """The documents that are not contaminated, all their columns unchanged."""
    mark = "found"
    while mark in docs.columns:
        mark += "_"
    found = scan(docs, benchmark, docs.columns, mark, max_words=max_words)
    return found.where(~contaminated(mark)).drop(mark)
