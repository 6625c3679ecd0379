"""Negative sampling, training set and split, all reproducible from a seed."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from almsflow.operators.relational import union_all, without_pairs
from almsflow.runtime import cut_lineage

_HALF = (1 << 32) - 1
#: Donors whose attempts a task holds at a time.
IN_PLACE = 500
#: Odd multipliers below 2^31, one a round, so that a product of 32-bit halves fits a long.
MULTIPLIERS = (0x5851F42D, 0x4C957F2D, 0x2545F491, 0x61C88647, 0x7FEB352D, 0x3C6EF35F)


def round_constants(seed: int) -> list[int]:
    """What a seed adds to the key of each round."""
    return [(seed * 0x9E3779B1 + i * 0x85EBCA6B) & _HALF for i in range(len(MULTIPLIERS))]


def draw(a: Column, b: Column, seed: int) -> Column:
    """Pseudo-random integer in [0, 2^63) from two longs and a seed.

    A counter-based generator: the halves of ``b`` pass six Feistel rounds whose keys are the halves of ``a``. For one ``a`` the
    rounds permute all 2^64 counters, so no two values of ``b`` share a state, and different ``a`` have different keys in any
    range. Plain integer arithmetic without overflow: the same on every engine and every retry.
    """
    halves = lambda x: (x.cast("long").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned(x.cast("long"), 32))
    keys, (left, right) = halves(a), halves(b)
    for i, (multiplier, constant) in enumerate(zip(MULTIPLIERS, round_constants(seed))):
        mixed = right.bitwiseXOR(keys[i % 2]).bitwiseXOR(F.lit(constant)) * F.lit(multiplier)
        left, right = right, left.bitwiseXOR(F.shiftright(mixed, 15).bitwiseAND(F.lit(_HALF)))
    return F.shiftleft(left, 31).bitwiseOR(F.shiftright(right, 1))


def _misses(donors: DataFrame, pairs: DataFrame, tried: Column, n_receivers: int, seed: int, chunk: int) -> DataFrame:
    """Attempts ``0 .. tried-1`` of each donor that hit none of its real pairs.

    Attempts are generated in fixed chunks spread over the cluster, so a donor
    with very many of them is not one task's work.
    """
    last = F.floor((F.col("tried") - 1) / chunk)
    chunks = (donors.withColumn("tried", tried)
              .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
              .repartition("donor_id", "chunk"))
    end = F.least((F.col("chunk") + 1) * chunk, F.col("tried")) - 1
    attempts = chunks.select("donor_id", "want", "total", "tried", "chunk",
                             F.explode(F.sequence(F.col("chunk") * chunk, end)).alias("attempt"))
    drawn = attempts.withColumn("receiver_id", draw(F.col("donor_id"), F.col("attempt"), seed) % n_receivers)
    return without_pairs(drawn, pairs, ["donor_id", "receiver_id"])


def _first_wanted(misses: DataFrame) -> DataFrame:
    """The first ``want`` misses of each donor, by attempt.

    Only per-chunk counts of a donor meet in one place; rows are numbered
    inside their chunk.
    """
    earlier = Window.partitionBy("donor_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = (misses.groupBy("donor_id", "chunk").agg(F.count(F.lit(1)).alias("hits"))
              .select("donor_id", "chunk", F.coalesce(F.sum("hits").over(earlier), F.lit(0)).alias("before")))
    in_chunk = Window.partitionBy("donor_id", "chunk").orderBy("attempt")
    return (misses.withColumn("nth", F.row_number().over(in_chunk))
            .join(before, ["donor_id", "chunk"])
            .filter(F.col("before") + F.col("nth") <= F.col("want"))
            .select("donor_id", "receiver_id"))


def _likely(n: Column, want: Column, total: Column, n_receivers: int, tries: int) -> Column:
    """About as many attempts as the donor's odds call for."""
    odds = F.greatest(1 - n / F.lit(float(n_receivers)), F.lit(1.0 / tries))
    return F.least(total, F.ceil(want / odds * 1.05 + 8))


def _drawn(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """:func:`draw` of whole arrays."""
    half, (a, b) = np.uint64(_HALF), (x.astype(np.int64).view(np.uint64) for x in (a, b))
    keys, left, right = (a & half, a >> np.uint64(32)), b & half, b >> np.uint64(32)
    for i, (multiplier, constant) in enumerate(zip(MULTIPLIERS, round_constants(seed))):
        mixed = (right ^ keys[i % 2] ^ np.uint64(constant)) * np.uint64(multiplier)
        left, right = right, left ^ (mixed >> np.uint64(15) & half)
    return (left << np.uint64(31) | right >> np.uint64(1)).astype(np.int64)


def _first_misses(donors: np.ndarray, want: np.ndarray, tried: np.ndarray, real: np.ndarray, n_receivers: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the donor and receiver of the first ``want`` of ``tried`` attempts that hit none of the real pairs
    (sorted ``place * n_receivers + receiver``), donor by donor in the order of the attempts."""
    row = np.repeat(np.arange(len(donors)), tried)
    attempt = np.arange(len(row)) - np.repeat(np.cumsum(tried) - tried, tried)
    receiver = _drawn(donors[row], attempt, seed) % n_receivers
    key = row * n_receivers + receiver
    at = np.searchsorted(real, key)
    miss = np.ones(len(key), bool)
    miss[at < len(real)] = real[at[at < len(real)]] != key[at < len(real)]
    row, receiver = row[miss], receiver[miss]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    return row[nth < want[row]], receiver[nth < want[row]]


def _in_place(donors: DataFrame, n_receivers: int, tries: int, seed: int) -> DataFrame:
    """The first ``want`` misses of donors that have few pairs, whose receivers stand in their row: no attempt is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, IN_PLACE):
                batch = whole.slice(at, IN_PLACE)
                ids, want, tried, total = (batch.column(c).to_numpy().astype(np.int64) for c in ("donor_id", "want", "tried", "total"))
                lists = batch.column("receivers")
                known = lists.flatten().to_numpy().astype(np.int64)
                own = np.repeat(np.arange(len(ids)), pc.list_value_length(lists).to_numpy())
                fits = (known >= 0) & (known < n_receivers)
                real = np.sort(own[fits] * n_receivers + known[fits])
                row, receiver = _first_misses(ids, want, tried, real, n_receivers, seed)
                short = (np.bincount(row, minlength=len(ids)) < want) & (tried < total)
                if short.any():
                    tried = np.where(short, total, tried)
                    row, receiver = _first_misses(ids, want, tried, real, n_receivers, seed)
                if len(row):
                    yield pa.RecordBatch.from_arrays([batch.column("donor_id").take(pa.array(row)), pa.array(receiver)], names=["donor_id", "receiver_id"])

    likely = _likely(F.col("n"), F.col("want"), F.col("total"), n_receivers, tries)
    asked = donors.select("donor_id", "want", likely.cast("long").alias("tried"), "total", "receivers")
    return asked.mapInArrow(run, f"donor_id {donors.schema['donor_id'].dataType.simpleString()}, receiver_id bigint")


def negative_samples(pairs: DataFrame, n_receivers: int, ratio: int = 5, tries: int = 3, seed: int = 42,
                     chunk: int = 4096) -> DataFrame:
    """``(donor_id, receiver_id)`` rows that are not real pairs, repeats allowed.

    A donor with n pairs makes up to ``n*ratio*tries`` attempts and keeps the
    first ``n*ratio`` that miss its real pairs. A first round makes about as
    many attempts as the donor's odds call for; the few donors that fall short
    go through all of theirs. Donors with at most ``chunk`` attempts make them in
    their own row; only those with more are dealt over the cluster.
    """
    want, n = F.col("want"), F.col("n")
    donors = (pairs.groupBy("donor_id").agg(F.count(F.lit(1)).alias("n"))
              .select("donor_id", "n", (n * ratio).alias("want"), (n * ratio * tries).alias("total")))
    # A place and a receiver are one long in a task; with more receivers than that allows, all donors go the other way.
    few = (F.col("total") <= chunk) & F.col("donor_id").isNotNull() & F.lit(n_receivers < (1 << 62) // IN_PLACE)
    own = pairs.join(donors.filter(few).select("donor_id"), "donor_id", "left_semi").groupBy("donor_id").agg(
        F.count(F.lit(1)).alias("n"), F.collect_set("receiver_id").alias("receivers")).select(
        "donor_id", "n", (n * ratio).alias("want"), (n * ratio * tries).alias("total"), "receivers")
    many = donors.filter(~few)
    return _in_place(own, n_receivers, tries, seed).unionByName(_dealt(many, pairs, n_receivers, tries, seed, chunk))


def _dealt(donors: DataFrame, pairs: DataFrame, n_receivers: int, tries: int, seed: int, chunk: int) -> DataFrame:
    """The first ``want`` misses of donors with many pairs, their attempts in chunks."""
    want = F.col("want")
    donors = cut_lineage(donors)
    if donors.isEmpty():
        return pairs.select("donor_id", "receiver_id").limit(0)
    pairs = pairs.join(donors.select("donor_id"), "donor_id", "left_semi")
    likely = _likely(F.col("n"), want, F.col("total"), n_receivers, tries)
    first = cut_lineage(_misses(donors, pairs, likely, n_receivers, seed, chunk))
    got = first.groupBy("donor_id").agg(F.count(F.lit(1)).alias("got"))
    short = (donors.withColumn("tried", likely).join(got, "donor_id", "left")
             .filter((F.coalesce("got", F.lit(0)) < want) & (F.col("tried") < F.col("total")))
             .select("donor_id", "want", "total"))
    again = _misses(short, pairs, F.col("total"), n_receivers, seed, chunk)
    settled = first.join(short.select("donor_id"), "donor_id", "left_anti")
    return _first_wanted(settled.unionByName(again))


def training_set(pairs: DataFrame, negatives: DataFrame) -> DataFrame:
    """Real pairs labelled 1 and sampled ones labelled 0; columns only one side has stay null."""
    return union_all(pairs.withColumn("label", F.lit(1)), negatives.withColumn("label", F.lit(0)))


def shuffled(samples: DataFrame, seed: int = 42) -> DataFrame:
    """Samples in a pseudo-random, reproducible order."""
    return samples.orderBy(draw(F.col("donor_id"), F.col("receiver_id"), seed), "donor_id", "receiver_id", "label")


def with_split(samples: DataFrame, train_percent: int = 85, seed: int = 42) -> DataFrame:
    """Mark each sample 'train' or 'val' by a hash of its pair: stable under any
    partitioning, and repeats of a pair never end up on both sides."""
    bucket = draw(F.col("donor_id"), F.col("receiver_id"), seed) % 100
    return samples.withColumn("split", F.when(bucket < train_percent, "train").otherwise("val"))


def smallest(rows: DataFrame, key: Column, share: float) -> tuple[int | None, int]:
    """The least value of a key from [0, 2^63) with ``ceil(n * share)`` rows up to it, and how many rows of that value belong to these.

    Counts rows by ever more bits of the key, 16 at a time: four passes at most, and 65,536 sums a pass come to the driver.
    """
    prefix, needed, shift, width = 0, None, 47, 16
    while True:
        own = rows if needed is None else rows.filter(F.shiftright(key, shift + width) == prefix)
        counts = sorted(tuple(r) for r in own.groupBy(F.shiftright(key, shift).bitwiseAND(F.lit((1 << width) - 1)).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
        if needed is None:
            needed = math.ceil(sum(n for _, n in counts) * share)
            if not needed:
                return None, 0
        for part, n in counts:
            if n >= needed:
                break
            needed -= n
        prefix = prefix << width | part
        if not shift:
            return prefix, needed
        shift, width = max(0, shift - 16), min(16, shift)


def with_exact_split(samples: DataFrame, val_share: float = 0.15, seed: int = 42) -> DataFrame:
    """Like :func:`with_split`, with exactly ``ceil(n * val_share)`` validation rows: those of the smallest draws.

    The border comes from counts; only the rows of the one draw at the border are numbered. Nothing is sorted or written.
    """
    key = draw(F.col("donor_id"), F.col("receiver_id"), seed)
    border, left = smallest(samples, key, val_share)
    if border is None:
        return samples.withColumn("split", F.lit("train"))
    clear = samples.filter(key != border).withColumn("split", F.when(key < border, "val").otherwise("train"))
    # One pair and its repeats, as good as always: the draw tells pairs apart.
    turn = F.row_number().over(Window.orderBy("donor_id", "receiver_id", "label"))
    return clear.unionByName(samples.filter(key == border).withColumn("split", F.when(turn <= left, "val").otherwise("train")))
