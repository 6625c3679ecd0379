"""Best partners of strings under the indel score, inside blocks, without scoring all pairs.

Two strings of lengths a, b that score t or more have a common subsequence of L >= t (a + b) / 200 characters,
and L is bounded from above by what the strings share as multisets:

* lengths: L <= min(a, b);
* characters: L is at most the number of shared characters;
* adjacent pairs of characters ("grams"): a gram of the first survives unless it is broken, so the strings share at
  least 3 L - a - b - 1 grams (count filter: Gravano et al. 2001), and L <= (shared + a + b + 1) / 3;
* scoring stops: the partners of a string are scored in the order of that upper bound, and no longer once it
  falls below the best score found.

What all pairs of two chunks share is counted at once: a string is a row of zeros and ones, one column per character or
gram and repetition, and the product of both sides' matrices holds the counts. Rare columns are cheaper pair by pair.
No pair is lost at any threshold.

A block's strings are dealt into chunks; every left chunk meets every right chunk in one group of bounded size,
so a block that holds a third of all rows is spread like any other. Small groups are scored together. The number of
pairs looked at stays the square of a block; what a pair costs is some tens of nanoseconds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from almsflow.functions.similarity import Lcs
from almsflow.runtime import cut_lineage

#: A group of chunks is one task's work at least, so their product bounds the longest task.
LEFT_CHUNK, RIGHT_CHUNK = 2_048, 2_048
#: Pairs of one block looked at directly, pairs or meetings held at a time, strings scored together.
SMALL, EXPANDED, TOGETHER = 256, 2_000_000, 20_000
#: Columns multiplied at a time, and the share of all pairs from which on a column is multiplied.
COLUMNS, DENSE = 1_024, 1 / 200
#: Pairs of strings in the blocks of one task, about.
PAIRS_PER_TASK = 4_000_000
_EPS = 1e-9


def needed(a, b, threshold: float):
    """Least common subsequence that reaches the threshold."""
    return np.ceil((a + b) * threshold / 200 - _EPS).astype(np.int64)


def _repeated(items: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items with their number of repetition in the row (the k-th of an item in a row is an item of its own), and their rows."""
    size = items.max(initial=0) + 1
    both = np.sort(row * size + items)
    index = np.arange(len(both))
    fresh = np.concatenate([[True], both[1:] != both[:-1]])[:len(both)]
    row, items = np.divmod(both, size)
    return items << 20 | np.minimum(index - np.maximum.accumulate(np.where(fresh, index, 0)), (1 << 20) - 1), row


def _characters(*sides: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Per side the characters of all texts (flat), numbered alike, and the text of each; and how many numbers there are."""
    codes = [np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) for texts in sides]
    used = np.zeros(max(int(c.max(initial=0)) for c in codes) + 1, bool)
    for c in codes:
        used[c] = True
    number = np.cumsum(used) - 1
    return [(number[c], np.repeat(np.arange(len(texts)), [len(t) for t in texts])) for c, texts in zip(codes, sides)], int(used.sum())


def _grams(characters: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Adjacent pairs of characters inside the texts, and the text of each."""
    inside = np.flatnonzero(owner[1:] == owner[:-1])
    return characters[inside] * size + characters[inside + 1], owner[inside]


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _slices(weights: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose weights add up to about the limit; one entry at least."""
    total, start = np.cumsum(weights), 0
    while start < len(weights):
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield start, stop
        start = stop


class _Shared:
    """How many items every left row shares with every right row, as multisets."""

    def __init__(self, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], n_left: int, n_right: int):
        self.n_right = n_right
        sides = [_repeated(*left), _repeated(*right)]
        common = np.intersect1d(sides[0][0], sides[1][0])
        columns, counts = [], []
        for items, row in sides:
            at = np.searchsorted(common, items)
            own = np.flatnonzero(common[np.minimum(at, len(common) - 1)] == items) if len(common) else np.empty(0, np.int64)
            columns.append((at[own], row[own]))
            counts.append(np.bincount(at[own], minlength=len(common)))
        dense = counts[0] * counts[1] >= n_left * n_right * DENSE
        number = np.cumsum(dense) - 1
        self.width = int(dense.sum())
        self.dense = [(number[c[dense[c]]], r[dense[c]]) for c, r in columns]
        # Rare columns: the left entries in the order of their rows, the right entries in that of their columns.
        (c, r), (rc, rr) = ((c[~dense[c]], r[~dense[c]]) for c, r in columns)
        self.row, column = r, c
        self.right = rr[np.argsort(rc, kind="stable")]
        ends = np.cumsum(np.bincount(rc, minlength=len(common)))
        self.sizes = counts[1][column]
        self.starts = ends[column] - self.sizes

    def of(self, begin: int, end: int) -> np.ndarray:
        """The counts of the left rows from ``begin`` to before ``end``."""
        out = np.zeros((end - begin, self.n_right), np.float32)
        for low in range(0, self.width, COLUMNS):
            part = []
            for (column, row), first, n in zip(self.dense, (begin, 0), (end - begin, self.n_right)):
                own = (column >= low) & (column < low + COLUMNS) & (row >= first) & (row < first + n)
                part.append(np.zeros((n, min(COLUMNS, self.width - low)), np.float32))
                part[-1][row[own] - first, column[own] - low] = 1
            out += part[0] @ part[1].T
        own = slice(*np.searchsorted(self.row, [begin, end]))
        row, sizes, starts = self.row[own] - begin, self.sizes[own], self.starts[own]
        for u, v in _slices(sizes, EXPANDED):
            met = np.repeat(row[u:v] * self.n_right, sizes[u:v]) + self.right[_runs(starts[u:v], sizes[u:v])]
            out += np.bincount(met, minlength=out.size).reshape(out.shape)
        return out


def candidates(left: list[str], right: list[str], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (left row, right row, longest possible common subsequence) that may reach the threshold, each once."""
    a_all, b_all = (np.array([len(t) for t in side], np.int64) for side in (left, right))
    if len(left) * len(right) <= SMALL:
        l, r = (x.ravel() for x in np.indices((len(left), len(right))))
        top = np.minimum(a_all[l], b_all[r])
        keep = top >= needed(a_all[l], b_all[r], threshold)
        yield l[keep], r[keep], top[keep]
        return
    (own, other), size = _characters(left, right)
    characters = _Shared(own, other, len(left), len(right))
    grams = _Shared(_grams(*own, size), _grams(*other, size), len(left), len(right))
    rows = max(1, EXPANDED // len(right))
    for begin in range(0, len(left), rows):
        end = min(begin + rows, len(left))
        a, b = a_all[begin:end, None], b_all[None]
        must = needed(a, b, threshold)
        shared = characters.of(begin, end)
        l, r = np.nonzero(shared >= must)
        # A bound from the characters alone already implies that of the lengths.
        top = np.minimum(shared[l, r].astype(np.int64), (grams.of(begin, end)[l, r].astype(np.int64) + a_all[begin + l] + b_all[r] + 1) // 3)
        keep = top >= must[l, r]
        yield begin + l[keep], r[keep], top[keep]


def score_of(lcs, a, b) -> np.ndarray:
    """Indel score, 0-100; two empty strings are equal."""
    both = a + b
    return np.where(both == 0, 100.0, 200.0 * lcs / np.maximum(both, 1))


def best_of(left: list[str], right: list[str], l, r, top, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Of candidate pairs the best of each left row, ties included: rows, scores, and how many pairs were scored."""
    a, b = np.array([len(t) for t in left], np.int64)[l], np.array([len(t) for t in right], np.int64)[r]
    limit = score_of(top, a, b)
    order = np.lexsort((-limit, l))
    l, r, limit, a, b = l[order], r[order], limit[order], a[order], b[order]
    turn = np.arange(len(l)) - np.searchsorted(l, l)
    best = np.full(len(left), float(threshold))
    score = np.full(len(l), -1.0)
    low, width, tried, common = 0, 1, 0, Lcs(left, right)
    while True:
        now = np.flatnonzero((turn >= low) & (limit >= best[l] - _EPS))
        if not len(now):
            break
        now = now[turn[now] < low + width]
        if len(now):
            score[now] = score_of(common.lengths(l[now], r[now]), a[now], b[now])
            np.maximum.at(best, l[now], score[now])
            tried += len(now)
        low, width = low + width, 2 * width
    won = np.flatnonzero((score >= 0) & (score >= threshold) & (score == best[l]))
    return l[won], r[won], score[won], tried


def _meetings(left: DataFrame, right: DataFrame, block: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Both sides' rows dealt to the groups in which their chunks meet, and the columns that name a group."""
    sizes = lambda side, size, name: side.groupBy(*block).agg(F.count(F.lit(1)).alias(f"_n{name}"), F.ceil(F.count(F.lit(1)) / size).cast("int").alias(f"_k{name}"))
    blocks = cut_lineage(sizes(left, LEFT_CHUNK, "l").join(sizes(right, RIGHT_CHUNK, "r"), [*block]))
    work, groups = blocks.agg(F.coalesce(F.sum(F.col("_nl").cast("double") * F.col("_nr")), F.lit(0.0)), F.coalesce(F.sum(F.col("_kl") * F.col("_kr")), F.lit(0))).first()
    slots = left.sparkSession.sparkContext.defaultParallelism
    width = int(max(1, min(groups, max(slots, math.ceil(work / PAIRS_PER_TASK)))))
    own = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    payload = F.struct(*[F.col(c) for c in right.columns if c not in (*block, "text")] or [F.lit(0).alias("_none")])

    def dealt(side: DataFrame, mine: str, others: str, is_left: bool, data) -> DataFrame:
        chunk, other = F.pmod(own, F.col(f"_k{mine}")).cast("int"), F.explode(F.sequence(F.lit(0), F.col(f"_k{others}") - 1))
        names = ("_lc", "_rc") if is_left else ("_rc", "_lc")
        rows = side.join(blocks, [*block]).select(*block, "text", data.alias("_data"), chunk.alias(names[0]), other.alias(names[1]))
        return rows.select(*block, "_rc", "_lc", F.lit(is_left).alias("_left"), "text", "_data")

    kind = right.select(payload.alias("d")).schema["d"].dataType
    key = [*block, "_rc", "_lc"]
    both = dealt(right, "r", "l", False, payload).union(dealt(left, "l", "r", True, F.lit(None).cast(kind)))
    return both.repartition(width, *key).sortWithinPartitions(*key, "_left"), key


def search(left: DataFrame, right: DataFrame, block: Sequence[str], threshold: float, best: bool = True) -> DataFrame:
    """``(block, text, r_text, score, right columns as r_...)``: per left row its best partners at the threshold or above.

    Both sides hold distinct ``(block, text)`` rows without nulls. All partners of the best score come out;
    with ``best=False`` instead every pair that may reach the threshold, unscored (-1).
    """
    met, key = _meetings(left, right, block)
    extra = met.schema["_data"].dataType
    schema = T.StructType([*[met.schema[c] for c in block], T.StructField("text", T.StringType()), T.StructField("r_text", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("_data", extra)])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one group at a time."""
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in key)))
            start = 0
            for i, now in enumerate([*keys, None]):
                if i and (now is None or now != keys[i - 1]):
                    if held and last != keys[start]:
                        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                        held = []
                    held.append(batch.slice(start, i - start))
                    last, start = keys[i - 1], i
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lefts, rights, parts, n_left, n_right = [], [], [], 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            if parts:
                left_rows, right_rows = (pa.Table.from_batches(x).combine_chunks() for x in (lefts, rights))
                texts, partners = left_rows.column("text").to_pylist(), right_rows.column("text").to_pylist()
                l, r, top = (np.concatenate([p[i] for p in parts]) for i in range(3))
                l, r, score, _ = best_of(texts, partners, l, r, top, threshold) if best else (l, r, np.full(len(l), -1.0), 0)
                l, r = pa.array(l), pa.array(r)
                columns = [*(left_rows.column(c).take(l) for c in (*block, "text")), right_rows.column("text").take(r), pa.chunked_array([pa.array(score)]), right_rows.column("_data").take(r)]
                yield from pa.Table.from_arrays(columns, names=schema.names).combine_chunks().to_batches()
            for x in (lefts, rights, parts):
                x.clear()

        for group in groups(batches):
            is_left = group.column("_left").to_numpy(zero_copy_only=False)
            mine, other = group.filter(pa.array(is_left)), group.filter(pa.array(~is_left))
            if not mine.num_rows or not other.num_rows:
                continue
            lefts.append(mine)
            rights.append(other)
            for l, r, top in candidates(mine.column("text").to_pylist(), other.column("text").to_pylist(), threshold):
                parts.append((l + n_left, r + n_right, top))
            n_left, n_right = n_left + mine.num_rows, n_right + other.num_rows
            if n_left + n_right >= TOGETHER or sum(len(p[0]) for p in parts) >= EXPANDED:
                yield from out()
                n_left = n_right = 0
        yield from out()

    found = met.mapInArrow(run, schema)
    return found.select(*block, "text", "r_text", "score", *[F.col(f"_data.{c}").alias(f"r_{c}") for c in extra.names if c != "_none"])
