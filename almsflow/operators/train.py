"""Logistic matrix factorisation by block-partitioned stochastic descent.

Donors and receivers are hashed into P blocks each. An epoch runs P strata; in
stratum s, donor block i meets receiver block (i + s) mod P, so no two tasks of
a stratum touch the same vector and all run at once (distributed SGD: Gemulla
et al., KDD 2011).

There is one training rule for every size: the samples of a block pair form batches by a hash, and a batch makes one
step. A block pair holding very many samples, as one very active donor causes, is trained by several tasks at once that take
the same steps together: each owns some of the receivers and their samples, and all add up their shares
of every batch's donor gradients (a barrier stage). Into how many tasks a pair is cut changes its time, not the model.

Adam moments travel with the vectors. Only touched rows are updated in a step;
a dense Adam would also move untouched rows by their momentum.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from almsflow.functions import vectors as V
from almsflow.operators.aggregates import split_metrics
from almsflow.operators.recommend import pair_scores
from almsflow.runtime import cut_lineage, fresh_path, no_leftovers, remove

BETA1, BETA2, EPS = 0.9, 0.999, 1e-8
BLOCK_BYTES = 256 << 20  # vectors and both moments of one block
FEWEST_BLOCKS = 8
PAIR_ROWS = 1_000_000  # samples of a block pair, on average, from which on there are more blocks
KEPT_EPOCHS = (1, 5, 10, 15, 20)  # fixed values: epochs whose state is saved

_STATE = "side string, id long, vec array<float>, m array<float>, v array<float>, t long"
_STEP = _STATE + ", weight long, loss double"


@dataclass(frozen=True)
class Settings:
    dim: int = 64
    epochs: int = 20
    batch: int = 1024
    learning_rate: float = 0.001
    init_std: float = 0.01
    blocks: int | None = None  # at least; None: as many as keep a block within BLOCK_BYTES
    task_rows: int = 2_000_000  # samples above which a block pair is shared by several tasks; no matter for the model
    seed: int = 42


def _uniform(*parts: Column) -> Column:
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) + 1) / F.lit(float((1 << 30) + 1))


def block_count(entities: int, s: Settings) -> int:
    """Blocks per side, so that a task holds at most about ``BLOCK_BYTES`` of each side's state."""
    return s.blocks or max(FEWEST_BLOCKS, -(-entities * s.dim * 12 // BLOCK_BYTES))


def enough_blocks(blocks: int, samples: int) -> int:
    """These blocks, or as many as bring the average pair down to ``PAIR_ROWS`` samples.

    More blocks mean more tasks side by side. Sharing large pairs instead would cost a meeting of all tasks per batch, so that is
    left to pairs that stay large, as one very active donor makes them.
    """
    return max(blocks, math.ceil(math.sqrt(samples / PAIR_ROWS)))


def init_vectors(ids: DataFrame, side: str, s: Settings) -> DataFrame:
    """Normal(0, init_std) vectors as a pure function of side, id, dimension and seed."""
    def normal(i: Column) -> Column:
        key = [F.lit(side), F.lit(s.seed), F.col("id"), i]
        radius = F.sqrt(-2 * F.log(_uniform(*key, F.lit(0))))
        return (radius * F.cos(2 * np.pi * _uniform(*key, F.lit(1))) * s.init_std).cast("float")

    zeros = F.array_repeat(F.lit(0.0).cast("float"), s.dim)
    vec = F.transform(F.sequence(F.lit(1), F.lit(s.dim)), normal)
    return ids.select(F.lit(side).alias("side"), F.col("id").cast("bigint").alias("id"), vec.alias("vec"),
                      zeros.alias("m"), zeros.alias("v"), F.lit(0).cast("bigint").alias("t"))


def _block(id_: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(n)).cast("int")


def _rows(table: pa.Table, name: str, dim: int) -> np.ndarray:
    flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim).astype(np.float32)


class _Side:
    """Vectors and moments of one block while a task trains on it."""

    def __init__(self, table: pa.Table, dim: int):
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        self.ids = table.column("id").to_numpy()[order]
        self.vec, self.m, self.v = (_rows(table, c, dim)[order] for c in ("vec", "m", "v"))
        self.t = table.column("t").to_numpy()[order].copy()
        self.weight = np.zeros(len(self.ids), dtype=np.int64)

    def locate(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, ids)

    def adam(self, rows: np.ndarray, total: np.ndarray, rate: float) -> None:
        """One step of these rows with their summed gradients."""
        total = total.astype(np.float32)
        self.t[rows] += 1
        m = self.m[rows] = BETA1 * self.m[rows] + (1 - BETA1) * total
        v = self.v[rows] = BETA2 * self.v[rows] + (1 - BETA2) * total * total
        t = self.t[rows, None]
        self.vec[rows] -= rate * (m / (1 - BETA1**t)) / (np.sqrt(v / (1 - BETA2**t)) + EPS)


def _summed(where: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients added up by row."""
    rows, back = np.unique(where, return_inverse=True)
    total = np.zeros((len(rows), grads.shape[1]))
    np.add.at(total, back, grads)
    return rows, total


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batch_numbers(donor: np.ndarray, receiver: np.ndarray, label: np.ndarray, batches: int, seed: int, epoch: int) -> np.ndarray:
    """The batch of every sample, as its ids, label and the epoch decide: the same whatever task holds it."""
    key = np.uint64((seed * 0x9E3779B97F4A7C15 + epoch * 0xD1B54A32D192ED03) & (2**64 - 1))
    with np.errstate(over="ignore"):
        x = _mixed(_mixed(_mixed(donor.astype(np.uint64) + key) + receiver.astype(np.uint64)) + label.astype(np.uint64))
    return (x % np.uint64(max(1, batches))).astype(np.int64)


class _Samples:
    """Samples of a block pair or of a part of it, batch by batch."""

    def __init__(self, table: pa.Table, donors: _Side, receivers: _Side, batches: int, seed: int, epoch: int):
        a, b, y = (table.column(c).to_numpy() for c in ("id", "other", "label"))
        number = batch_numbers(a, b, y, batches, seed, epoch)
        order = np.lexsort((y, b, a, number))  # rows arrive in any order after a retry
        self.at = np.searchsorted(number[order], np.arange(batches + 1))
        self.d, self.r, self.y = donors.locate(a[order]), receivers.locate(b[order]), y[order].astype(np.float32)

    def batch(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = slice(self.at[k], self.at[k + 1])
        return self.d[own], self.r[own], self.y[own]


def _slopes(donors: _Side, receivers: _Side, d: np.ndarray, r: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Both sides' vectors, the slope of every sample's loss, and the loss."""
    left, right = donors.vec[d], receivers.vec[r]
    score = np.einsum("ij,ij->i", left, right)
    loss = float(np.sum(np.maximum(score, 0) - score * label + np.log1p(np.exp(-np.abs(score)))))
    return left, right, (1 / (1 + np.exp(-score)) - label)[:, None].astype(np.float64), loss


def _list(matrix: np.ndarray) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1).astype(np.float32)))


_NAMES = ["side", "id", "vec", "m", "v", "t", "weight", "loss"]


def _split(table: pa.Table, dim: int) -> tuple[_Side, _Side, pa.Table]:
    kind = table.column("side").to_numpy(zero_copy_only=False)
    donors, receivers = (_Side(table.filter(pa.array(kind == k)), dim) for k in ("d", "r"))
    return donors, receivers, table.filter(pa.array(kind == "s"))


def _result(sides: list[tuple[str, _Side]], rows: int, loss: float) -> pa.Table:
    parts = [pa.table([pa.array([k] * len(x.ids)), pa.array(x.ids), _list(x.vec), _list(x.m), _list(x.v),
                       pa.array(x.t), pa.array(np.zeros(len(x.ids), np.int64)), pa.nulls(len(x.ids), pa.float64())], names=_NAMES)
             for k, x in sides if len(x.ids)]
    nothing = _list(np.zeros((1, 0)))
    parts.append(pa.table([pa.array(["loss"]), pa.array([0]), nothing, nothing, nothing, pa.array([0]),
                           pa.array([rows]), pa.array([loss])], names=_NAMES))
    return pa.concat_tables(parts)


def _trainer(s: Settings, epoch: int):
    def train_block(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(parts)
        if not sum(b.num_rows for b in parts):
            return
        donors, receivers, given = _split(pa.Table.from_batches(parts), s.dim)
        batches = -(-given.num_rows // s.batch)
        samples, loss = _Samples(given, donors, receivers, batches, s.seed, epoch), 0.0
        for k in range(batches):
            d, r, label = samples.batch(k)
            if not len(d):
                continue
            left, right, slope, lost = _slopes(donors, receivers, d, r, label)
            loss += lost
            mine, other = _summed(d, slope * right / len(d)), _summed(r, slope * left / len(d))
            donors.adam(*mine, s.learning_rate)
            receivers.adam(*other, s.learning_rate)
        yield from _result([("d", donors), ("r", receivers)], given.num_rows, loss).combine_chunks().to_batches()

    return train_block


def _packed(pair: int, count: int, ids: np.ndarray, total: np.ndarray) -> str:
    return base64.b64encode(np.array([pair, count, len(ids)], np.int64).tobytes() + ids.astype(np.int64).tobytes() + total.astype(np.float64).tobytes()).decode()


def _unpacked(message: str, dim: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    raw = base64.b64decode(message)
    pair, count, n = np.frombuffer(raw, np.int64, 3).tolist()
    return pair, count, np.frombuffer(raw, np.int64, n, 24), np.frombuffer(raw, np.float64, n * dim, 24 + 8 * n).reshape(n, dim)


def _sharing_trainer(s: Settings, epoch: int, slots: list[tuple[int, int, int]]):
    """For a barrier stage: task k has ``slots[k]``, its block pair, its part and the pair's number of batches.

    Parts of a pair have all its donors and their own receivers. After each batch they exchange how many samples they had
    of it and the sums of their donor gradients, add these up in the order of the parts, and so stay alike.
    """
    rounds = max(n for _, _, n in slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        pair, part, n_batches = slots[context.partitionId()]
        donors, receivers, given = _split(pa.Table.from_batches(list(batches)), s.dim)
        samples, loss = _Samples(given, donors, receivers, n_batches, s.seed, epoch), 0.0
        for k in range(rounds):
            mine = other = None
            if k < n_batches:
                d, r, label = samples.batch(k)
                left, right, slope, lost = _slopes(donors, receivers, d, r, label)
                loss += lost
                rows, total = _summed(d, slope * right)
                mine, other = _packed(pair, len(d), donors.ids[rows], total), _summed(r, slope * left)
            got = [_unpacked(m, s.dim) for m in context.allGather(mine or "") if m]
            of_pair = [g for g in got if g[0] == pair]
            count = sum(g[1] for g in of_pair)
            if k < n_batches and count:
                rows, total = _summed(np.concatenate([donors.locate(g[2]) for g in of_pair]), np.concatenate([g[3] for g in of_pair]))
                donors.adam(rows, total / count, s.learning_rate)
                receivers.adam(other[0], other[1] / count, s.learning_rate)
        yield from _result([*([("d", donors)] if part == 0 else []), ("r", receivers)], given.num_rows, loss).combine_chunks().to_batches()

    return run


def _placed_samples(samples: DataFrame, s: Settings, path: str) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """Samples with their block pair, written to ``path`` by stratum, and how many each pair that needs several tasks has.

    A stratum reads only its own folder. The size table has at most blocks squared rows, so the driver may hold it.
    """
    placed = samples.select(
        F.col("donor_id").cast("bigint").alias("id"), F.col("receiver_id").cast("bigint").alias("other"),
        F.col("label").cast("int").alias("label"), _block(F.col("donor_id"), s.blocks).alias("db"),
        _block(F.col("receiver_id"), s.blocks).alias("rb")).withColumn("shift", F.pmod(F.col("rb") - F.col("db"), F.lit(s.blocks)))
    with no_leftovers(samples.sparkSession):
        placed.write.partitionBy("shift").parquet(path)
    placed = samples.sparkSession.read.schema(placed.schema).parquet(path)
    sizes = placed.groupBy("db", "rb").count().filter(F.col("count") > s.task_rows).collect()
    return placed, {(x["db"], x["rb"]): x["count"] for x in sizes}


def shared_slots(hot: dict[int, int], slots: int, s: Settings) -> list[tuple[int, int, int]]:
    """Tasks of a stratum's barrier stage, from the sizes of its large pairs: (pair, part, batches) each; no more than can run at once."""
    out = []
    for pair, count in sorted(hot.items()):
        parts = min(-(-count // s.task_rows), slots // len(hot))
        if parts > 1:
            out += [(pair, part, -(-count // s.batch)) for part in range(parts)]
    return out


def _stratum(state: DataFrame, placed: DataFrame, large: dict[tuple[int, int], int], shift: int, epoch: int,
             s: Settings, path: str) -> DataFrame:
    p, spark = s.blocks, state.sparkSession
    block = _block(F.col("id"), p)
    task = F.when(F.col("side") == "d", block).otherwise(F.pmod(block - shift, F.lit(p)))
    vectors = state.withColumn("task", task)
    # Empty rather than null vectors: Arrow transfer of null lists is very slow.
    none = F.array().cast("array<float>")
    rows = placed.filter(F.col("shift") == shift).select(
        F.lit("s").alias("side"), "id", "other", "label", F.col("db").alias("task"), *[none.alias(c) for c in ("vec", "m", "v")])
    both = vectors.unionByName(rows, allowMissingColumns=True)
    # Tasks of a barrier stage start together, which executors that come and go do not allow.
    fixed = spark.conf.get("spark.dynamicAllocation.enabled", "false") == "false"
    slots = shared_slots({k[0]: n for k, n in large.items() if (k[1] - k[0]) % p == shift}, spark.sparkContext.defaultParallelism if fixed else 1, s)
    pairs = {pair: sum(x[0] == pair for x in slots) for pair, _, _ in slots}
    alone = both.filter(~F.col("task").isin(list(pairs))) if pairs else both
    # One partition per task, so that none waits for another that fell into its partition.
    out = cut_lineage(alone.repartitionById(p, "task").drop("task").mapInArrow(_trainer(s, epoch), _STEP), f"{path}/alone")
    if pairs:
        first = {pair: min(i for i, x in enumerate(slots) if x[0] == pair) for pair in pairs}
        table = F.create_map(*[F.lit(x) for pair, n in pairs.items() for x in (pair, F.struct(F.lit(first[pair]).alias("first"), F.lit(n).alias("n")))])
        there = table[F.col("task")]
        receiver = F.when(F.col("side") == "r", F.col("id")).otherwise(F.col("other"))
        part = F.pmod(F.xxhash64(receiver, F.lit(1)), there["n"]).cast("int")
        slot = F.when(F.col("side") == "d", F.sequence(there["first"], there["first"] + there["n"] - 1)).otherwise(F.array(there["first"] + part))
        shared = both.filter(F.col("task").isin(list(pairs))).withColumn("slot", F.explode(slot))
        # Written by itself: a barrier stage cannot be part of a union.
        out = out.union(cut_lineage(shared.repartitionById(len(slots), "slot").drop("slot", "task").mapInArrow(_sharing_trainer(s, epoch, slots), _STEP, barrier=True), f"{path}/shared"))
    return out


def evaluate(samples: DataFrame, state: DataFrame) -> DataFrame:
    d, r = (state.filter(F.col("side") == k).select("id", "vec") for k in ("d", "r"))
    return split_metrics(pair_scores(samples, d, r))


def save_state(state: DataFrame, path: str, tag: str) -> None:
    """Replace the vectors stored under ``tag``; other tags stay."""
    with no_leftovers(state.sparkSession):
        (state.select(F.lit(tag).alias("tag"), "side", "id", "vec").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("tag", "side").parquet(path))


def load_vectors(spark: SparkSession, path: str, tag: str = "best") -> tuple[DataFrame, DataFrame]:
    """Donor and receiver ``(id, vec)`` tables of a saved state (partition-pruned reads)."""
    saved = spark.read.schema("id long, vec array<float>, tag string, side string").parquet(path)
    return tuple(saved.filter((F.col("tag") == tag) & (F.col("side") == k)).select("id", "vec") for k in ("d", "r"))


def train(train_set: DataFrame, val_set: DataFrame, donors: DataFrame, receivers: DataFrame,
          model_path: str, settings: Settings = Settings()) -> DataFrame:
    """Train, save states by tag (``epoch_N``, ``best``, ``final``) and return
    ``(epoch, train_loss, val_loss, accuracy)`` with one row per epoch.

    A stratum's state replaces the one before, which goes as soon as the next is written; so do the placed samples in the end.
    """
    spark = train_set.sparkSession
    s = replace(settings, blocks=enough_blocks(block_count(max(donors.count(), receivers.count()), settings), train_set.count()))
    path = fresh_path(spark, "training")
    placed, large = _placed_samples(train_set, s, f"{path}/samples")
    held = f"{path}/state-0"
    state = cut_lineage(init_vectors(donors, "d", s).unionByName(init_vectors(receivers, "r", s)), held)
    history, best = [], float("inf")
    for epoch in range(1, s.epochs + 1):
        loss_sum = loss_rows = 0.0
        for shift in range(s.blocks):
            after = f"{path}/state-{epoch}-{shift}"
            out = _stratum(state, placed, large, shift, epoch, s, after)
            remove(spark, held)
            held = after
            got = out.filter("side = 'loss'").agg(F.sum("loss"), F.sum("weight")).first()
            loss_sum, loss_rows = loss_sum + (got[0] or 0.0), loss_rows + (got[1] or 0)
            state = out.filter("side <> 'loss'").drop("weight", "loss")
        with no_leftovers(spark):
            val = evaluate(val_set, state).first()
        history.append((epoch, loss_sum / max(loss_rows, 1), val["loss"], val["accuracy"]))
        tags = [f"epoch_{epoch}"] if epoch in KEPT_EPOCHS else []
        if val["loss"] is not None and val["loss"] < best:
            best, tags = val["loss"], [*tags, "best"]
        for tag in [*tags, *(["final"] if epoch == s.epochs else [])]:
            save_state(state, model_path, tag)
    remove(spark, path)
    return spark.createDataFrame(history, "epoch int, train_loss double, val_loss double, accuracy double")


def gradients(samples: DataFrame, donors: DataFrame, receivers: DataFrame, dim: int) -> DataFrame:
    """Full-batch gradient of the mean logistic loss: ``(side, id, grad)``.

    Plain joins and sums, so it is the checkable twin of the block trainer; a
    hot entity is pre-aggregated before the shuffle.
    """
    n = samples.count()
    d = donors.select(F.col("id").alias("donor_id"), F.col("vec").alias("dv"))
    r = receivers.select(F.col("id").alias("receiver_id"), F.col("vec").alias("rv"))
    rows = (samples.join(d, "donor_id").join(r, "receiver_id")
            .withColumn("slope", (V.sigmoid(V.dot(F.col("dv"), F.col("rv"))) - F.col("label")) / n))

    def side(name: str, id_: str, other: str) -> DataFrame:
        sums = [F.sum(F.col(other)[i].cast("double") * F.col("slope")) for i in range(dim)]
        return rows.groupBy(F.lit(name).alias("side"), F.col(id_).alias("id")).agg(F.array(*sums).alias("grad"))

    return side("d", "donor_id", "rv").unionByName(side("r", "receiver_id", "dv"))


def descend(vectors: DataFrame, grads: DataFrame, side: str, rate: float) -> DataFrame:
    """``vec - rate * grad``; vectors without a gradient stay."""
    g = grads.filter(F.col("side") == side).select("id", "grad")
    moved = F.zip_with(F.col("vec"), F.col("grad"), lambda x, y: x.cast("double") - rate * y)
    return (vectors.join(g, "id", "left")
            .select("id", F.coalesce(moved, F.col("vec").cast("array<double>")).alias("vec")))
