"""Substring dedup with prefix-partitioned suffix trees.

A window is 50 consecutive words. A word goes if it lies in a window whose words also start in a
document with a smaller doc_id. Suffixes of all documents are far too many to ship, so:

1. Every window has an anchor, the smallest hash of the 25-word sequences in it, which equal
   windows share. Only anchors that occur in two different texts can mark a repeat. Equal texts
   count once: all windows of a later copy are repeats anyhow.
2. The suffixes of windows with such anchors are dealt out by prefix: the anchor's 25 words. Text is
   shipped as slices that hold the run of neighbouring windows with one anchor. A group's suffixes
   are sorted to a depth of 50 words; equal neighbours hang below one deep internal node of the
   group's suffix tree. The smallest doc_id below a node keeps its words.
3. Where a prefix group is too large for a task (``GROUP`` suffixes), its suffixes get a longer
   prefix, all 50 words of the window; the smallest doc_id per prefix is then a sum-like
   aggregate that is combined before the shuffle, whatever the size of the group.

Marks go back to their documents as runs of window starts; a document's marks are bounded by its
own length.

Defined cases: null text has no words; documents of fewer than 50 words lose nothing; rows without
id count as larger than any id; rows with one id do not remove from each other; an empty table
gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from almsflow.llm.neardup import _HASHES, _mix
from almsflow.llm.tables import arrow_map, utf8, words
from almsflow.runtime import cut_lineage

WINDOW = 50
#: Suffixes of one prefix group that a task holds at once, 50 words of each.
GROUP = 25_000
LAST_ID = (1 << 63) - 1

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(which: int, n: int) -> np.ndarray:
    """Powers of the base or of its inverse, 0..n-1, modulo 2^64."""
    if len(_powers[which]) < n:
        step = np.full(2 * n, (_BASE, _INVERSE)[which], np.uint64)
        step[0] = 1
        _powers[which] = np.cumprod(step)
    return _powers[which][:n]


def sequence_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive word hashes."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _power(0, len(h)))])
    n = len(h) - size + 1
    return _mix((sums[size:] - sums[:n]) * _power(1, n))


def anchors(found: list[bytes], window: int = WINDOW) -> np.ndarray:
    """For each window its anchor: the smallest hash of the half-window sequences inside."""
    if len(found) < window:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    least = sequence_hashes(h, window // 2)
    span, reach = window - window // 2 + 1, 1
    while 2 * reach <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = span - reach
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def _runs(marked: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())


def _digest(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


_WORK = ("kind int, id long, t1 long, key long, key2 long, pos int, n_words long, n_removed long, sha string, body binary")
_FINAL, _HELD, _SLICE, _WINDOW = range(4)


def _work_batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _deal_out(joined: DataFrame, window: int) -> DataFrame:
    """Finished documents, documents that wait for marks, slices of common prefixes, windows of very common ones."""
    schema = pa.schema([("kind", pa.int32()), ("id", pa.int64()), ("t1", pa.int64()), ("key", pa.int64()), ("key2", pa.int64()),
                        ("pos", pa.int32()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("sha", pa.string()), ("body", pa.binary())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            shared, hot = batch.column("shared").to_pylist(), batch.column("hot").to_pylist()
            ids, firsts, t1s = (batch.column(c).to_pylist() for c in ("id", "first", "t1"))
            for i, raw in enumerate(utf8(batch.column("text"))):
                found, n = words(raw), 0
                if ids[i] > firsts[i] and len(found) >= window:  # a later copy of a whole text
                    rows.append((_FINAL, ids[i], t1s[i], None, None, None, len(found), len(found), _digest([]), None))
                    continue
                marked = np.empty(0, bool)
                if ids[i] == firsts[i] and (shared[i] or hot[i]):
                    own = anchors(found, window).view(np.int64)
                    often = np.isin(own, np.array(hot[i] or [], np.int64))
                    marked = np.isin(own, np.array(shared[i] or [], np.int64))
                    change = np.flatnonzero(np.diff(own)) + 1
                    for a, b in zip([0, *change.tolist()], [*change.tolist(), len(own)]):
                        if marked[a]:
                            body = b" ".join(found[a:b - 1 + window])
                            rows.append((_SLICE, ids[i], t1s[i], int(own[a]), None, a, None, None, None, body))
                            n += len(body)
                    for p in np.flatnonzero(often).tolist():
                        k = np.frombuffer(hashlib.blake2b(b" ".join(found[p:p + window]), digest_size=16).digest(), np.int64)
                        rows.append((_WINDOW, ids[i], t1s[i], int(k[0]), int(k[1]), p, None, None, None, None))
                        n += 64
                        if len(rows) >= 50_000:
                            yield _work_batches(rows, schema)
                            rows = []
                    marked = marked | often
                if marked.any():
                    rows.append((_HELD, ids[i], t1s[i], None, None, None, None, None, None, raw))
                    n += len(raw)
                else:
                    rows.append((_FINAL, ids[i], t1s[i], None, None, None, len(found), 0, _digest(found), None))
                held += n + 100
                if held > 8_000_000:
                    yield _work_batches(rows, schema)
                    rows, held = [], 0
        if rows:
            yield _work_batches(rows, schema)

    return joined.select("id", "first", "t1", "text", "shared", "hot").mapInArrow(deal, _WORK)


def subtree_marks(slices: list[tuple[int, int, int, bytes]], window: int) -> list[tuple[int, int, int, int]]:
    """Repeated windows of one prefix group: ``(id, t1, first, end)`` runs of window starts.

    ``slices`` are ``(id, t1, position, text)``. Sorted suffixes stand like the leaves of a suffix
    tree; those that agree in ``window`` words share a deep node.
    """
    suffixes: list[tuple[bytes, int, int]] = []
    for number, (_, _, _, text) in enumerate(slices):
        text += b" "
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1
        starts = np.concatenate([[0], ends[:-1]])
        # No deeper than a window: a long run of one word would else cost the square of its length.
        suffixes += [(text[a:b], number, d) for d, (a, b) in enumerate(zip(starts.tolist(), ends[window - 1:].tolist()))]
    suffixes.sort()
    marks: dict[int, list[int]] = {}
    for _, below in groupby(suffixes, key=itemgetter(0)):
        leaves = [(number, d) for _, number, d in below]
        owner = min(slices[number][0] for number, _ in leaves)
        for number, d in leaves:
            if slices[number][0] > owner:
                marks.setdefault(number, []).append(slices[number][2] + d)
    out = []
    for number, found in marks.items():
        found.sort()
        cut = [0, *(i for i in range(1, len(found)) if found[i] != found[i - 1] + 1), len(found)]
        out += [(slices[number][0], slices[number][1], found[a], found[b - 1] + 1) for a, b in zip(cut, cut[1:])]
    return out


_MARKS = "id long, t1 long, first int, end int"


def _cold_marks(work: DataFrame, window: int) -> DataFrame:
    """Marks of the prefix groups; every group is one run of a sorted partition and bounded by ``GROUP`` suffixes."""

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, slices, out = None, [], []
        for batch in batches:
            for k, i, t, p, body in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "t1", "pos", "body"))):
                if k != key:
                    out += subtree_marks(slices, window) if len(slices) > 1 else []
                    key, slices = k, []
                slices.append((i, t, p, body))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["id", "t1", "first", "end"])
                out = []
        out = subtree_marks(slices, window) if len(slices) > 1 else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["id", "t1", "first", "end"])

    slices = work.where(F.col("kind") == _SLICE).select("key", "id", "t1", "pos", "body")
    return slices.repartition("key").sortWithinPartitions("key").mapInArrow(group, _MARKS)


def _hot_marks(work: DataFrame) -> DataFrame:
    rows = work.where(F.col("kind") == _WINDOW).select("key", "key2", "id", "t1", "pos")
    owners = cut_lineage(rows.groupBy("key", "key2").agg(F.min("id").alias("_owner")))
    repeated = rows.join(owners, ["key", "key2"]).where(F.col("id") > F.col("_owner"))
    return repeated.select("id", "t1", F.col("pos").alias("first"), (F.col("pos") + 1).alias("end"))


def _finish(held: DataFrame, window: int) -> DataFrame:
    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, digests = [], [], []
        for raw, marks in zip(utf8(batch.column("body")), batch.column("marks").to_pylist()):
            found = words(raw)
            edge = np.zeros(len(found) + 1, np.int32)
            for m in marks or []:
                edge[m["first"]] += 1
                edge[m["end"] - 1 + window] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            n_words.append(len(found))
            n_removed.append(int(gone.sum()))
            digests.append(_digest([found[i] for i in np.flatnonzero(~gone).tolist()] if n_removed[-1] else found))
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
                                          names=["id", "n_words", "n_removed", "sha"])

    return arrow_map(held, finish, "id long, n_words long, n_removed long, sha string")


def repeated_substrings(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
                        F.xxhash64("text").alias("t1"), F.coalesce(F.octet_length("text"), F.lit(-1)).alias("len"), "text")

    def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [np.unique(anchors(words(raw), window), return_counts=True) for raw in utf8(batch.column("text"))]
        owner = np.repeat(batch.column("t1").to_numpy(zero_copy_only=False), [len(a) for a, _ in own])
        flat = np.concatenate([np.empty(0, np.uint64), *(a for a, _ in own)])
        count = np.concatenate([np.empty(0, np.int64), *(n for _, n in own)])
        return pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64)), pa.array(owner, pa.int64()), pa.array(count, pa.int32())], names=["key", "t1", "n"])

    placed = arrow_map(keyed.select("t1", "text"), emit, "key long, t1 long, n int")
    shared = cut_lineage(placed.groupBy("key").agg(F.min("t1").alias("_a"), F.max("t1").alias("_b"), F.sum("n").alias("_n"))
                         .where(F.col("_a") != F.col("_b")).select("key", (F.col("_n") > group).alias("_hot")))
    own = placed.join(shared, "key").groupBy("t1").agg(
        F.collect_set(F.when(~F.col("_hot"), F.col("key"))).alias("shared"), F.collect_set(F.when(F.col("_hot"), F.col("key"))).alias("hot"))
    firsts = keyed.groupBy("t1", "len").agg(F.min("id").alias("first"))
    # Written, so that the join below can be split where one text is very common.
    info = cut_lineage(firsts.join(own, "t1", "left"))
    work = cut_lineage(_deal_out(keyed.join(info, ["t1", "len"]), window))
    marks = (_cold_marks(work, window).union(_hot_marks(work)).groupBy("id", "t1").agg(F.collect_list(F.struct("first", "end")).alias("marks")))
    held = work.where(F.col("kind") == _HELD).select("id", "t1", "body").join(marks, ["id", "t1"], "left")
    done = work.where(F.col("kind") == _FINAL).select("id", "n_words", "n_removed", "sha")
    return done.union(_finish(held.select("id", "body", "marks"), window)).select(
        F.nullif("id", F.lit(LAST_ID)).alias("doc_id"), "n_words", "n_removed", F.col("sha").alias("kept_sha256"))
