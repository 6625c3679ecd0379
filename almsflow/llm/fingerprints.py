"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds the polynomial hash, modulo a prime, of every prefix of its code points.
It answers whether any two spans are equal in constant time, and binary search over spans
finds the longest common extension of two places. A fingerprint keeps

* length and hash of the whole text;
* hashes of its beginnings and ends at geometrically spaced lengths, so that the same binary search tells how much two texts
  share at both ends, as far as these lengths tell;
* hash and length of spans that cover the text, cut where the text itself says so: in front of ``WINDOW`` code points whose hash ends in
  ``level`` zero bits. The level is the least that leaves ``MOST`` cuts, so a fingerprint stays small and short texts are
  cut finely. Each cut has its number of zero bits: hashes of neighbouring spans add up to the hash of both, so a
  finely cut fingerprint can be brought to the level of a coarser one.

``likeness`` compares two fingerprints and nothing else: the share of the longer text in equal spans, wherever they stand, or at both
ends, if that is more. An edit costs the span it falls into.

Neighbours in doc_id order come together in one shuffle: quantiles of doc_id cut the table into
ranges, every range also gets the first row of the next one, and each task streams its sorted
range once.

Defined cases: null text is empty; empty texts are like each other (1) and unlike all else (0);
rows without id come last; rows with one id follow the order of their texts; after the last row
comes the first; the next of a single row is itself; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_000_003, 69_069_069)
#: Kept lengths per doubling.
PER_OCTAVE = 4
#: Code points that decide a cut, zero bits of the finest level, and cuts of a fingerprint at most.
WINDOW, FINEST, MOST = 5, 2, 192
#: Longest span in one entry; a longer one is several, parted by cuts of no strength.
LONGEST = (1 << 12) - 1
LAST_ID = (1 << 63) - 1
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_inverses = np.ones(1, np.uint64)


def powers(which: int, n: int) -> np.ndarray:
    """``BASES[which] ** i`` modulo the prime for i < n; grown by doubling."""
    p, have = np.uint64(PRIMES[which]), _powers[which]
    while len(have) < n:
        step = np.uint64(pow(BASES[which], len(have), PRIMES[which]))
        have = np.concatenate([have, have * step % p])
    _powers[which] = have
    return have[:n]


def inverses(n: int) -> np.ndarray:
    """``BASES[0] ** -i`` modulo the prime for i < n; grown by doubling."""
    global _inverses
    p = np.uint64(PRIMES[0])
    while len(_inverses) < n:
        step = np.uint64(pow(BASES[0], -len(_inverses), PRIMES[0]))
        _inverses = np.concatenate([_inverses, _inverses * step % p])
    return _inverses[:n]


class PrefixHash:
    """Prefix arrays of one text under both primes."""

    def __init__(self, text: str = ""):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        self.sums = []
        for k, p in enumerate(PRIMES):
            terms = codes * powers(k, self.n) % np.uint64(p)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms) % np.uint64(p)]))

    def replaced_tail(self, keep: int, other: PrefixHash, taken: int) -> PrefixHash:
        """The arrays of the first ``keep`` code points followed by the first ``taken`` of another text, from these arrays alone."""
        out = PrefixHash()
        out.n, out.sums = keep + taken, []
        for k, prime in enumerate(PRIMES):
            p = np.uint64(prime)
            tail = other.sums[k][1:taken + 1] * np.uint64(pow(BASES[k], keep, prime)) % p
            out.sums.append(np.concatenate([self.sums[k][:keep + 1], (tail + self.sums[k][keep]) % p]))
        return out

    def raw(self, k: int, start, end):
        """Sum of the terms of a span: its hash times BASE ** start."""
        p = np.uint64(PRIMES[k])
        return (self.sums[k][end] + p - self.sums[k][start]) % p


def spans_equal(a: PrefixHash, i: int, b: PrefixHash, j: int, length: int) -> bool:
    """Whether ``length`` code points from i in one text equal those from j in the other."""
    if i + length > a.n or j + length > b.n:
        return False
    for k, p in enumerate(PRIMES):
        # Each sum carries its own start as a power; multiplying by the other's makes them comparable.
        left = int(a.raw(k, i, i + length)) * pow(BASES[k], j, p) % p
        right = int(b.raw(k, j, j + length)) * pow(BASES[k], i, p) % p
        if left != right:
            return False
    return True


def longest_common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """How many code points agree from i and j on."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def kept_lengths(n: int) -> np.ndarray:
    """1, 2, 3, ... then ``PER_OCTAVE`` lengths per doubling, up to n."""
    if n == 0:
        return np.empty(0, np.int64)
    steps = np.arange(int(np.log2(n) * PER_OCTAVE) + 1)
    return np.unique(np.floor(2.0 ** (steps / PER_OCTAVE) + 1e-9).astype(np.int64))


def cuts(h: PrefixHash) -> tuple[int, np.ndarray, np.ndarray]:
    """Level, places and strengths of a text's cuts, places ascending."""
    n = h.n - WINDOW + 1
    if n < 2:
        return FINEST, np.empty(0, np.int64), np.empty(0, np.int64)
    p, places = np.uint64(PRIMES[0]), np.arange(n)
    found = h.raw(0, places, places + WINDOW) * inverses(n) % p
    mixed = found * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
    strength = np.bitwise_count((mixed & (~mixed + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    strong = np.flatnonzero((strength >= FINEST) & np.concatenate([[False], found[1:] != found[:-1]]))  # runs are not cut
    above = np.bincount(np.minimum(strength[strong], 15), minlength=16)[::-1].cumsum()[::-1]
    level = next((k for k in range(FINEST, 16) if above[k] <= MOST), 16)
    strong = strong[strength[strong] >= level]
    return level, strong, np.minimum(strength[strong], 15)


def _spans(h: PrefixHash) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Level, and hash, length and the strength of the cut in front, of every span."""
    level, at, strength = cuts(h)
    starts, strength = np.concatenate([[0], at]), np.concatenate([[15], strength])
    sizes = np.diff(np.append(starts, h.n))
    if len(sizes) and sizes.max() > LONGEST:
        parts = -(-sizes // LONGEST)
        first = np.cumsum(parts) - parts
        inner = np.arange(parts.sum()) - np.repeat(first, parts)
        starts = np.repeat(starts, parts) + inner * LONGEST
        strength = np.where(inner == 0, np.repeat(strength, parts), 0)
        sizes = np.diff(np.append(starts, h.n))
    hashes = h.raw(0, starts, starts + sizes) * inverses(h.n)[starts] % np.uint64(PRIMES[0])
    return level, hashes, sizes, strength


def fingerprint(text: str | PrefixHash) -> str:
    """``length.hash.beginnings.ends.level.spans``; four hex digits per kept length, six bytes in Base64 per span."""
    h = PrefixHash(text) if isinstance(text, str) else text
    whole = "".join(f"{int(s[-1]):08x}" for s in h.sums)
    if not h.n:
        return f"0.{whole}..." + f"{FINEST}."
    lengths = kept_lengths(h.n)
    first = h.sums[0][lengths] & np.uint64(0xFFFF)
    last = h.raw(0, h.n - lengths, h.n) * inverses(h.n)[h.n - lengths] % np.uint64(PRIMES[0]) & np.uint64(0xFFFF)
    level, hashes, sizes, strength = _spans(h)
    entries = np.empty(len(sizes), _ENTRY)
    entries["hash"], entries["rest"] = hashes, sizes << 4 | strength
    return ".".join([str(h.n), whole, *(part.astype(">u2").tobytes().hex() for part in (first, last)), str(level), base64.b64encode(entries.tobytes()).decode()])


_ENTRY = np.dtype([("hash", "<u4"), ("rest", "<u2")])


def _agreeing(a: str, b: str, lengths: np.ndarray) -> int:
    """The largest kept length at which two lists of hashes still agree, by binary search."""
    low, high = 0, len(lengths)
    while low < high:
        middle = (low + high + 1) // 2
        if a[4 * middle - 4:4 * middle] == b[4 * middle - 4:4 * middle]:
            low = middle
        else:
            high = middle - 1
    return int(lengths[low - 1]) if low else 0


def _at_level(packed: str, level: int) -> np.ndarray:
    """Hash and length, as one number, of every span between cuts of the level."""
    entries = np.frombuffer(base64.b64decode(packed), _ENTRY)
    hashes, sizes, strength = entries["hash"].astype(np.uint64), (entries["rest"] >> 4).astype(np.int64), entries["rest"] & 15
    strength[0] = 15
    first = np.flatnonzero(strength >= min(level, 15)) if level < 16 else np.array([0])
    if len(first) < len(sizes):
        p, starts = np.uint64(PRIMES[0]), np.cumsum(sizes) - sizes
        n = int(sizes.sum())
        prefix = np.concatenate([[0], np.cumsum(hashes * powers(0, n)[starts] % p)]).astype(np.uint64)
        ends = np.append(first[1:], len(sizes))
        hashes = (prefix[ends] - prefix[first]) % p * inverses(n)[starts[first]] % p
        sizes = np.add.reduceat(sizes, first)
    return hashes << np.uint64(32) | sizes.astype(np.uint64)


def likeness(a: str, b: str) -> float:
    """Share of the longer text that two texts have in common, as far as their fingerprints tell."""
    if a == b:
        return 1.0
    (na, _, first_a, last_a, level_a, spans_a), (nb, _, first_b, last_b, level_b, spans_b) = a.split("."), b.split(".")
    na, nb = int(na), int(nb)
    if not na or not nb:
        return 0.0
    lengths = kept_lengths(min(na, nb))
    at_ends = _agreeing(first_a, first_b, lengths) + _agreeing(last_a, last_b, lengths)
    level = max(int(level_a), int(level_b))
    (one, n_one), (two, n_two) = (np.unique(_at_level(x, level), return_counts=True) for x in (spans_a, spans_b))
    both, i, j = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    in_spans = int((np.minimum(n_one[i], n_two[j]) * (both & np.uint64(0xFFFFFFFF)).astype(np.int64)).sum())
    return min(max(at_ends, in_spans), na, nb) / max(na, nb)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the first as many code points of the next text."""
    tail = len(text) // 4
    return text[:len(text) - tail] + following[:tail]


def _bounds(ids: DataFrame, ranges: int) -> list[int]:
    """Ascending doc_ids that end the ranges; their number is bounded by ``ranges``."""
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = ids.agg(F.percentile_approx("_id", shares, max(10_000, 10 * ranges)).alias("b")).first()["b"]
    return sorted(set(found or []))


def _range_of(column, bounds: list[int]):
    """Number of bounds below the id, by two small searches: among every 64th bound, then in its block."""
    if not bounds:
        return F.lit(0)
    blocks = [bounds[i:i + 64] for i in range(0, len(bounds), 64)]
    ends = F.array(*[F.lit(b[-1]) for b in blocks])
    block = F.size(F.filter(ends, lambda e: e < column))
    inside = F.array(*[F.array(*[F.lit(x) for x in b]) for b in blocks])
    return block * 64 + F.coalesce(F.size(F.filter(F.get(inside, block), lambda e: e < column)), F.lit(0))


_OUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
                     T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
                     T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each own row with the row after it; one row is remembered between batches."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None
    for batch in batches:
        out = []
        for part, lent, i, text in zip(*(batch.column(c).to_pylist() for c in ("_part", "_lent", "_id", "text"))):
            text = text or ""
            own = PrefixHash(text)
            own_print = fingerprint(own)
            if held and held[0] == part:
                _, before, before_text, before_hash, before_print = held
                tail = len(before_text) // 4
                changed = fingerprint(before_hash.replaced_tail(len(before_text) - tail, own, min(tail, len(text))))
                out.append((before if before != LAST_ID else None, len(before_text), hashlib.sha256(edited(before_text, text).encode()).hexdigest(), before_print,
                            changed, likeness(before_print, changed), likeness(before_print, own_print)))
            held = None if lent else (part, i, text, own, own_print)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=_OUT.names)


def fingerprints(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per document: fingerprint, that of its edited text, and how like it is to that and to the next document."""
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_id"), "text")
    bounds = _bounds(keyed.select("_id"), ranges)
    placed = keyed.withColumn("_part", _range_of(F.col("_id"), bounds).cast("int"))
    heads = sorted((r["_part"], r["head"]) for r in placed.groupBy("_part").agg(F.min("_id").alias("head")).collect())
    if not heads:
        return spark.createDataFrame([], _OUT)
    # One row per range: its first id and the range before, which needs that row too.
    lent = [(head, heads[k - 1][0], k == 0) for k, (_, head) in enumerate(heads)]
    lent_to = F.broadcast(spark.createDataFrame(lent, "_id long, _to int, _wraps boolean"))
    copies = F.when(F.col("_to").isNotNull(), F.array(F.struct(F.col("_part"), F.lit(False).alias("_lent")), F.struct(F.col("_to").alias("_part"), F.lit(True).alias("_lent")))) \
        .otherwise(F.array(F.struct(F.col("_part"), F.lit(False).alias("_lent"))))
    dealt = placed.join(lent_to, "_id", "left").select(F.explode(copies).alias("_c"), "_id", "text").select("_c._part", "_c._lent", "_id", "text")
    return dealt.repartition("_part").sortWithinPartitions("_part", "_lent", "_id", "text").mapInArrow(_pair_rows, _OUT)
