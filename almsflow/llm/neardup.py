"""Near-duplicate groups from SetSketch registers.

A document's set of word shingles becomes a SetSketch: for each of ``REGISTERS`` hash functions the
smallest exponential draw of the set's elements, truncated to exponentially spaced levels
(base ``BASE``). Registers merge by maximum, and registers of similar sets agree with about the
probability of their Jaccard similarity, so hashes of five registers at a time put similar sets
into common buckets.

1. Equal sets form classes, named by their smallest doc_id; only class representatives go on.
2. Every bucket links its members to its smallest one. These pairs are estimated jointly by
   likelihood from the counts of larger, smaller and equal registers and the known set sizes;
   pairs far below the threshold go, the rest is verified on the full sets. Confirmed links
   give first components.
3. A bucket whose members are all in one component needs no more work, so a group of near copies
   costs one pair per member and not all pairs. In other buckets, a set most of whose shingles no
   other unsettled set has can have no link and goes. What is left of connected buckets is a
   cluster; its sets are compared exactly, chunk by chunk, and only links between components
   come out, never pairs.

With 25 buckets of five registers a pair at the threshold of 0.85 is missed with probability below
1e-6, one at 0.9 below 1e-9. The estimate drops pairs six standard errors below the threshold.

Defined cases: a document without words has an empty set, is its own component and linked with
nothing; fewer words than a shingle form one shingle; rows without id are told apart by their
text, count as larger than any id (ids stay below 2^62) and come back as null; repeated rows are
equal sets; rows that repeat an id with another text share its component; an empty table gives
an empty result; only doc_id and text are read, other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from almsflow.llm.components import components
from almsflow.llm.tables import arrow_map, lowered, row_struct, steps, utf8, words
from almsflow.runtime import cut_lineage

BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
BASE = 1.01
#: Estimates this far under the threshold are not verified: six standard errors of 125 registers at 0.85.
SLACK = 0.2
NO_ID = 1 << 62

_U64 = np.uint64
_M1, _M2, _M3 = _U64(0x9E3779B97F4A7C15), _U64(0xC2B2AE3D27D4EB4F), _U64(0x165667B19E3779F9)
#: Odd multipliers, one hash function each.
_FACTORS = np.random.default_rng(125).integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * _U64(2) + _U64(1)
_BLOCK = 16_384
#: Documents and text bytes of one side of a comparison group.
CHUNK, CHUNK_BYTES = 256, 4_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U64(32))
    x = x * _M1
    x = x ^ (x >> _U64(29))
    x = x * _M2
    return x ^ (x >> _U64(32))


class _WordHashes(dict):
    """Word -> 64-bit hash, remembered; forgotten as a whole when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


_HASHES = _WordHashes()


def shingles(raw: bytes, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    found = words(lowered(raw))
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = out * _M3 + h[k:len(h) - n + 1 + k]
        out ^= out >> _U64(31)
    return np.unique(_mix(out))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch levels, ``(sets, REGISTERS)``; every set has elements."""
    least = np.empty((len(sets), REGISTERS), np.uint64)
    start, held = 0, 0
    for i, s in enumerate(sets):
        held += len(s)
        if held >= _BLOCK or i + 1 == len(sets):
            block = sets[start:i + 1]
            flat = np.concatenate(block)
            at = np.cumsum([0, *(len(b) for b in block[:-1])])
            for k in range(REGISTERS):
                least[start:i + 1, k] = np.minimum.reduceat(flat * _FACTORS[k], at)
            start, held = i + 1, 0
    draws = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64)
    return np.clip(np.floor(1 - np.log(np.maximum(draws, 1e-20)) / np.log(BASE)), 0, 65535).astype(np.uint16)


def bucket_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    grouped = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), grouped.shape[:2]).copy()
    for k in range(ROWS):
        key = _mix(key * _M3 + grouped[:, :, k])
    return key.view(np.int64)


def likely_similarity(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from two register arrays and the set sizes.

    With shares u and v of the sizes, a's register is the larger one with probability
    p(u - v j), b's with p(v - u j), where p(x) = -log_BASE(1 - x (BASE-1)/BASE).
    """
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = REGISTERS - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u
    top = np.minimum(u / v, v / u)
    best, found = np.full(len(a), -np.inf), np.zeros(len(a))
    for share in np.linspace(0, 1, 201):
        j = top * share
        p = -np.log1p(-np.maximum(u - v * j, 1e-12) * (BASE - 1) / BASE) / np.log(BASE)
        q = -np.log1p(-np.maximum(v - u * j, 1e-12) * (BASE - 1) / BASE) / np.log(BASE)
        value = more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))
        better = value > best
        best, found = np.where(better, value, best), np.where(better, j, found)
    return found


_SKETCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("size", T.LongType()),
    T.StructField("c1", T.LongType()), T.StructField("c2", T.LongType()),
    T.StructField("regs", T.BinaryType())])


def node(doc_id: str = "doc_id", text: str = "text"):
    """The document's id; without one, a number above all ids that its text decides."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID) + F.pmod(F.xxhash64(text), F.lit(NO_ID)))


def _public(column):
    return F.when(column < NO_ID, column)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """Per document: id, set size, 128-bit set identity, registers (null for an empty set)."""

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        raws = utf8(batch.column("text"))
        sizes, ids, regs = [], [], []
        for a, b in steps(raws):
            sets = [shingles(raw, size) for raw in raws[a:b]]
            full = [s for s in sets if len(s)]
            own = registers(full) if full else np.empty((0, REGISTERS), np.uint16)
            k = 0
            for s in sets:
                sizes.append(len(s))
                ids.append(np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64))
                regs.append(own[k].tobytes() if len(s) else None)
                k += len(s) > 0
        pair = np.array(ids).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(pair[:, 0]), pa.array(pair[:, 1]),
             pa.array(regs, pa.binary())], names=_SKETCH.names)

    return arrow_map(docs.select(node().alias("doc_id"), "text"), sketch, _SKETCH)


def _bucket_rows(reps: DataFrame) -> DataFrame:
    """``(doc_id, key)``: one row per set and band."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), BANDS)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(bucket_keys(regs).ravel())], names=["doc_id", "key"])

    return arrow_map(reps.select("doc_id", "regs"), rows, "doc_id long, key long")


def _likely(pairs: DataFrame, sketched: DataFrame, least: float) -> DataFrame:
    """Pairs ``(a, b)`` whose sizes allow the threshold and whose estimate comes near it."""
    one = sketched.select(F.col("doc_id").alias("a"), F.col("size").alias("na"), F.col("regs").alias("ra"))
    two = sketched.select(F.col("doc_id").alias("b"), F.col("size").alias("nb"), F.col("regs").alias("rb"))
    sized = pairs.join(one, "a").join(two, "b").where((F.least("na", "nb") >= least * F.greatest("na", "nb")))

    def near(batch: pa.RecordBatch) -> pa.RecordBatch:
        ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
        na, nb = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("na", "nb"))
        keep = likely_similarity(ra, rb, na, nb) >= least - SLACK
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return arrow_map(sized.select("a", "b", "na", "nb", "ra", "rb"), near, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union of their full sets."""
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, known = [], {}
        for ta, tb in zip(utf8(batch.column("ta")), utf8(batch.column("tb"))):
            if tb not in known:  # pairs with one hub mostly come together
                known = {tb: shingles(tb, size)}
            sa, sb = shingles(ta, size), known[tb]
            both = len(np.intersect1d(sa, sb, assume_unique=True))
            keep.append(100 * both >= percent * (len(sa) + len(sb) - both))
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return arrow_map(pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb"), check, "a long, b long")


def _sharable(texts: DataFrame, size: int) -> DataFrame:
    """Per text, how many of its shingles no other of the texts has (texts without such ones are left out)."""

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(raw, size) for raw in utf8(batch.column("text"))]
        owner = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), [len(s) for s in sets])
        flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), pa.array(flat.view(np.int64))], names=["doc_id", "shingle"])

    rows = arrow_map(texts, spread, "doc_id long, shingle long")
    # Shingles of one text alone keep its id as minimum and maximum; they are counted per text and taken off.
    return (rows.groupBy("shingle").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("_other"))
              .where(F.col("doc_id") == F.col("_other")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("alone")))


def _undecided(rows: DataFrame, group: str) -> DataFrame:
    """Rows of groups whose members are in more than one component."""
    split = cut_lineage(rows.groupBy(group).agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low < _high").select(group))
    return rows.join(split, group)


def linked_across(rows: list[tuple[int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """One link for each two components among ``(id, component, set)`` rows that any link joins.

    Intersections are counted exactly, as products of 0/1 matrices over slices of the shared shingles.
    """
    sizes = np.array([len(s) for _, _, s in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    _, place, count = np.unique(np.concatenate([s for _, _, s in rows]), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    enough = 100 * np.bincount(owner[shared], minlength=len(rows)) >= percent * sizes
    kept = np.flatnonzero(enough)
    roots = np.array([r for _, r, _ in rows])[kept]
    if len(kept) < 2 or (roots == roots[0]).all():
        return []
    use = shared & enough[owner]
    columns, column = np.unique(place[use], return_inverse=True)
    line = np.searchsorted(kept, owner[use])
    both = np.zeros((len(kept), len(kept)), np.float32)
    for begin in range(0, len(columns), 4096):
        own = (column >= begin) & (column < begin + 4096)
        matrix = np.zeros((len(kept), min(4096, len(columns) - begin)), np.float32)
        matrix[line[own], column[own] - begin] = 1
        both += matrix @ matrix.T
    n = sizes[kept]
    linked = (100 * both >= percent * (n[:, None] + n[None, :] - both)) & (roots[:, None] < roots[None, :])
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for i, j in zip(*np.nonzero(linked)):
        found.setdefault((roots[i], roots[j]), (rows[kept[i]][0], rows[kept[j]][0]))
    return list(found.values())


def _cross_links(placed: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between the components of each cluster, from ``(doc_id, root, cluster)``.

    A cluster is dealt into chunks of about ``CHUNK`` documents or ``CHUNK_BYTES`` of text; every two chunks
    meet in one task group, so a cluster of any size is compared whole and no group grows with it.
    """
    held = cut_lineage(_undecided(placed, "cluster").join(texts.withColumn("_n", F.octet_length("text")), "doc_id"))
    total = cut_lineage(held.groupBy("cluster").agg(F.greatest(F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum("_n") / CHUNK_BYTES)).cast("int").alias("_k")))
    chunk = F.pmod(F.xxhash64("doc_id"), F.col("_k")).cast("int")
    others = F.when(F.col("_k") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("_k") - 1), lambda j: j != F.col("_c")))
    dealt = (held.join(total, "cluster").withColumn("_c", chunk).withColumn("_j", F.explode(others))
             .select(F.xxhash64("cluster", F.least("_c", "_j"), F.greatest("_c", "_j")).alias("meet"), "doc_id", "root", "text"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            out = []
            for k, i, r, raw in zip(batch.column("meet").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("root").to_pylist(), utf8(batch.column("text"))):
                if k != key:
                    out += linked_across(rows, percent) if len(rows) > 1 else []
                    key, rows = k, []
                rows.append((i, r, shingles(raw, size)))
            yield _links(out)
        yield _links(linked_across(rows, percent) if len(rows) > 1 else [])

    return dealt.repartition("meet").sortWithinPartitions("meet").mapInArrow(meet, "a long, b long")


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])


def grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per document: node (its id or stand-in), n_shingles, root (smallest node reachable)."""
    least = percent / 100
    sketched = cut_lineage(sketches(docs, size))
    # Written, so that the join below can be split where one set is very common.
    by_set = cut_lineage(sketched.where("size > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("class")))
    members = sketched.select("doc_id", "size", "c1", "c2").join(by_set, ["c1", "c2"], "left")
    members = cut_lineage(members.select("doc_id", "size", F.coalesce("class", "doc_id").alias("class")))
    names = members.where("size > 0").select(F.col("class").alias("doc_id")).distinct()
    # Rows that repeat an id with another text are one node; their sets all stay in play.
    reps = cut_lineage(sketched.where("size > 0").join(names, "doc_id").drop("c1", "c2"))

    placed = _bucket_rows(reps)
    hubs = cut_lineage(placed.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("_other"))
                       .where(F.col("hub") < F.col("_other")).select("key", "hub"))
    shared = cut_lineage(placed.join(hubs, "key").select("key", "doc_id", "hub"))
    stars = shared.where(F.col("doc_id") > F.col("hub")).select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    likely = cut_lineage(_likely(stars, reps, least))

    involved = shared.select("doc_id").distinct()
    keyed = docs.where(F.col("text").isNotNull()).select(node().alias("doc_id"), "text")
    texts = cut_lineage(keyed.join(involved, "doc_id"))
    links = cut_lineage(_verified(likely, texts, size, percent))
    first = components(links)

    home = shared.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    open_keys = cut_lineage(_undecided(home, "key"))
    unsettled = texts.join(open_keys.select("doc_id").distinct(), "doc_id")
    alone = _sharable(unsettled, size)
    sizes = reps.groupBy("doc_id").agg(F.max("size").alias("n"), F.min("size").alias("n_low"))
    # Most shingles of a linked set are in another set too.
    possible = (open_keys.join(sizes, "doc_id").join(alone, "doc_id", "left")
                .where(F.col("n") - F.coalesce("alone", F.lit(0)) >= least * F.col("n_low")).select("key", "doc_id", "root"))
    possible = cut_lineage(_undecided(possible, "key"))
    hub = possible.groupBy("key").agg(F.min("doc_id").alias("b"))
    clusters = components(possible.join(hub, "key").select(F.col("doc_id").alias("a"), "b"))
    placed = possible.select("doc_id", "root").distinct().join(clusters.withColumnRenamed("node", "doc_id").withColumnRenamed("root", "cluster"), "doc_id", "left")
    more = _cross_links(placed.withColumn("cluster", F.coalesce("cluster", "doc_id")), texts, size, percent)

    roots = components(links.union(more))
    return members.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        F.col("doc_id").alias("node"), F.col("size").alias("n_shingles"), F.coalesce("root", "class").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= ``percent`` * |union| of their shingle sets;
    component_id is the smallest doc_id reachable over links (null where none has an id).
    """
    out = grouped(docs, size, percent)
    return out.select(_public(F.col("node")).alias("doc_id"), "n_shingles", _public(F.col("root")).alias("component_id"),
                      (F.col("node") == F.col("root")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of every near-duplicate group: the one of the smallest doc_id; columns unchanged.

    Of rows that repeat an id and its text one stays.
    """
    first = grouped(docs, size, percent).where("node = root").select("node").distinct()
    # The row travels as one struct, so that no column of the caller meets one of these names.
    turn = F.row_number().over(Window.partitionBy("node", "same").orderBy("same"))
    own = docs.select(node().alias("node"), F.xxhash64("text").alias("same"), row_struct(docs).alias("row")).join(first, "node", "left_semi")
    return own.withColumn("turn", turn).where("turn = 1").select("row.*")
