"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is dealt into blocks of documents by a hash. Its target, in words, fixes how many
whole passes over its blocks the mix makes and which blocks, in a permuted order, fill the
rest; the last of them is cut between two documents. So each source has an exact quota of
block draws. A binary tree over the output shards then splits the vector of quotas: each node
gives its left half a multivariate hypergeometric draw. A shard's share of a source is a run of
the source's permuted draws; runs are disjoint and together are all draws. Documents are put
in a hashed order inside their shard.

The driver sees one row per source (``MAX_SOURCES`` at most, refused beyond) and one per block
(``MAX_BLOCKS`` in all plus one per source), whatever the size of the corpus; documents only
look their block up. The table of blocks is broadcast under that bound.

Defined cases: null text and text without words have size 0 and are never drawn beyond the passes
of their source; null is a source of its own and sorts last; a source without words has target 0;
repeated rows share their block and are drawn together; an empty table gives an empty mix; the
columns ``mix_copy``, ``mix_shard`` and ``mix_order`` replace any of that name. Reruns agree: all
draws come from seeds and from hashes of ids and texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from almsflow.llm.tables import row_struct, uniform

MAX_SOURCES = 50_000
MAX_BLOCKS = 32_768
MIN_BLOCK_WORDS = 2_000
MAX_COPIES = 3
#: Words of the mix in one output shard, so that a shard stays as large as a task can sort; 16 shards at least.
SHARD_WORDS, MIN_SHARDS = 8_000_000, 16
SEED = 9
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], most: int = MAX_COPIES) -> dict[str | None, float]:
    """Shares of the total by weight; none above ``most`` times its size, the excess reshared."""
    out: dict[str | None, float] = {}
    left, total = dict(weights), float(sum(sizes.values()))
    while left:
        unit = total / sum(left.values())
        over = [s for s, w in left.items() if w * unit > most * sizes[s]]
        if not over:
            return out | {s: w * unit for s, w in left.items()}
        for s in over:
            out[s] = float(most * sizes[s])
            total -= out[s]
            del left[s]
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """``(shards, sources)`` counts that add up to the quotas exactly."""
    if shards == 1:
        return quotas[None, :]
    half = shards // 2
    take = int(quotas.sum()) * half // shards
    left = rng.multivariate_hypergeometric(quotas, take, method="marginals")
    return np.vstack([split_quotas(left, half, rng), split_quotas(quotas - left, shards - half, rng)])


@dataclass
class Plan:
    """What the mix does: per source its size and target, per block its draws."""

    sizes: dict[str | None, int]
    targets: dict[str | None, float]
    n_blocks: dict[str | None, int]
    draws: list[tuple]  # (source, block, copies of every document, shard of each draw, place up to which one more is drawn)


def _compact(docs: DataFrame, *more: Column) -> DataFrame:
    """Source, words, and the two hashes that decide a document's block and its place in it."""
    ident = F.struct("doc_id", "text")
    return docs.select(*more, F.col("source").alias("_source"), n_words().alias("_words"),
                       uniform(ident, SEED).alias("_u"), uniform(ident, SEED + 1).alias("_place"))


def _block(blocks: Column) -> Column:
    return F.least(F.floor(F.col("_u") * blocks), blocks - 1).cast("int")


def plan(docs: DataFrame, weights=None, shards: int | None = None, seed: int = SEED) -> Plan:
    """Decide every draw. ``weights(sources)`` gives each source's weight; by default 1, 2, 3, repeating."""
    spark, compact = docs.sparkSession, _compact(docs)
    found = compact.groupBy("_source").agg(F.sum("_words").alias("words")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r["_source"]: r["words"] for r in sorted(found, key=lambda r: (r["_source"] is None, r["_source"] or ""))}
    weight = weights(list(sizes)) if weights else {s: float(1 + i % 3) for i, s in enumerate(sizes)}
    goal, total = targets(sizes, weight), sum(sizes.values())
    shards = shards or max(MIN_SHARDS, -(-total // SHARD_WORDS))
    block_words = max(MIN_BLOCK_WORDS, -(-total // MAX_BLOCKS))
    n_blocks = {s: max(1, -(-size // block_words)) for s, size in sizes.items()}
    if not sizes:
        return Plan(sizes, goal, n_blocks, [])
    table = F.broadcast(spark.createDataFrame([(s, n) for s, n in n_blocks.items()], "_s string, _n int"))
    blocked = compact.join(table, F.col("_source").eqNullSafe(F.col("_s"))).withColumn("_block", _block(F.col("_n")))
    weights_of: dict[str | None, list[tuple[int, int]]] = {s: [] for s in sizes}
    for r in blocked.groupBy("_source", "_block").agg(F.sum("_words").alias("words")).collect():
        weights_of[r["_source"]].append((r["_block"], r["words"]))
    rng = np.random.default_rng(seed)
    picked: dict[str | None, list[tuple[int, int]]] = {}
    cut_at: dict[str | None, tuple[int, float]] = {}
    passes: dict[str | None, int] = {}
    for s, size in sizes.items():
        passes[s] = min(MAX_COPIES, int(goal[s] // size)) if size else 0
        rest = 0.0 if passes[s] == MAX_COPIES or not size else goal[s] - passes[s] * size
        own = sorted(weights_of[s])
        order, extra = rng.permutation(len(own)), []
        for i in order.tolist():
            block, words = own[i]
            if words > rest:
                if rest > 0:
                    cut_at[s] = (block, rest)
                    extra.append(block)
                break
            rest -= words
            extra.append(block)
        picked[s] = [(b, c) for c in range(passes[s]) for b, _ in own] + [(b, passes[s]) for b in extra]
    names = list(sizes)
    alloc = split_quotas(np.array([len(picked[s]) for s in names], np.int64), shards, rng)
    places = _cut_places(blocked, cut_at)
    draws = []
    for k, s in enumerate(names):
        own = picked[s]
        shard_of = np.repeat(np.arange(shards), alloc[:, k])
        by_block: dict[int, dict[int, int]] = {}
        for i, shard in zip(rng.permutation(len(own)).tolist(), shard_of.tolist()):
            by_block.setdefault(own[i][0], {})[own[i][1]] = shard
        cut_block = cut_at.get(s, (None, 0))[0]
        for block, copies in sorted(by_block.items()):
            draws.append((s, block, [copies[c] for c in sorted(copies)], places.get(s, -1.0) if block == cut_block else None))
    return Plan(sizes, goal, n_blocks, draws)


def _cut_places(blocked: DataFrame, cut_at: dict[str | None, tuple[int, float]]) -> dict[str | None, float]:
    """For each source's last block the place of the last document taken, as near to the rest as whole documents come."""
    if not cut_at:
        return {}
    table = F.broadcast(blocked.sparkSession.createDataFrame([(s, b, r) for s, (b, r) in cut_at.items()], "_s2 string, _b2 int, _rest double"))
    # One block per source: a 32,768th of the corpus at most, and only numbers of each document.
    upto = Window.partitionBy("_source").orderBy("_place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = (blocked.join(table, F.col("_source").eqNullSafe(F.col("_s2")) & (F.col("_block") == F.col("_b2")))
           .select("_source", "_place", "_words", "_rest", F.sum("_words").over(upto).alias("_sum")))
    # Up to the document that crosses the rest, if that is nearer than stopping before it.
    near = own.where((F.col("_sum") <= F.col("_rest")) | (F.col("_sum") - F.col("_rest") < F.col("_rest") - (F.col("_sum") - F.col("_words"))))
    return {r["_source"]: r["place"] for r in near.groupBy("_source").agg(F.max("_place").alias("place")).collect()}


def _placed(rows: DataFrame, mix: Plan) -> DataFrame:
    """``rows`` of (row, _source, _u, _place) with ``_shards``: the output shard of each copy the mix takes."""
    spark = rows.sparkSession
    blocks = F.broadcast(spark.createDataFrame([(s, n) for s, n in mix.n_blocks.items()], "_s string, _n int"))
    draws = F.broadcast(spark.createDataFrame(mix.draws, "_s2 string, _b2 int, _draws array<int>, _cut double"))
    placed = (rows.join(blocks, F.col("_source").eqNullSafe(F.col("_s")), "left").withColumn("_block", _block(F.col("_n")))
              .join(draws, F.col("_source").eqNullSafe(F.col("_s2")) & (F.col("_block") == F.col("_b2")), "left"))
    whole = F.coalesce("_draws", F.array().cast("array<int>"))
    taken = F.when(F.col("_cut").isNotNull() & (F.col("_place") > F.col("_cut")), F.slice(whole, 1, F.size(whole) - 1)).otherwise(whole)
    return placed.withColumn("_shards", taken)


def with_draws(docs: DataFrame, mix: Plan) -> DataFrame:
    """``(row, _shards)``: every document as one struct, so that its columns may have any name, and the shards of its copies."""
    ident = F.struct("doc_id", "text")
    rows = docs.select(row_struct(docs).alias("row"), F.col("source").alias("_source"), uniform(ident, SEED).alias("_u"), uniform(ident, SEED + 1).alias("_place"))
    return _placed(rows, mix).select("row", "_shards")


def report(docs: DataFrame, mix: Plan) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, and how many copies the mix takes."""
    numbers = [(s, mix.sizes[s], mix.targets[s]) for s in mix.sizes]
    per_source = F.broadcast(docs.sparkSession.createDataFrame(numbers, "_source string, source_size long, target double"))
    compact = _compact(docs.select("doc_id", "text", "source"), F.col("doc_id").alias("doc_id"))
    out = _placed(compact, mix).join(per_source.withColumnRenamed("_source", "_s3"), F.col("_source").eqNullSafe(F.col("_s3")), "left")
    return out.select("doc_id", F.col("_words").alias("size"), "source_size", "target", (F.col("_words") * F.size("_shards")).alias("taken"), F.size("_shards").alias("copies"))


def copies(docs: DataFrame, mix: Plan) -> DataFrame:
    """A row per copy that the mix takes, with ``mix_copy`` and ``mix_shard``, not yet brought together."""
    own = docs.drop("mix_copy", "mix_shard", "mix_order")
    return with_draws(own, mix).select("row", F.posexplode("_shards").alias("mix_copy", "mix_shard")).select("row.*", "mix_copy", "mix_shard")


def mixed(docs: DataFrame, mix: Plan) -> DataFrame:
    """The mix itself: a row per copy with ``mix_copy``, ``mix_shard`` and ``mix_order``, shuffled inside each shard."""
    rows = copies(docs, mix).withColumn("mix_order", F.xxhash64(F.lit(SEED + 2), "doc_id", "text", "mix_copy"))
    return rows.repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_order")
