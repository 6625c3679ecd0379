"""Scoring and top-k over embedding tables ``(id, vec)``."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from almsflow.functions import vectors as V
from almsflow.operators.ids import ranked_within


def embedding_of(vectors: DataFrame, id_: int) -> list[float]:
    """The vector of one id (a single pruned row)."""
    row = vectors.filter(F.col("id") == id_).select("vec").first()
    if row is None:
        raise ValueError(f"unknown id {id_}")
    return list(row["vec"])


def score_against(vectors: DataFrame, query: Sequence[float]) -> DataFrame:
    """One query vector against a whole table: a projection, no join and no shuffle."""
    literal = F.array(*[F.lit(float(x)) for x in query])
    return vectors.withColumn("score", V.dot(F.col("vec"), literal))


def pair_scores(pairs: DataFrame, donors: DataFrame, receivers: DataFrame) -> DataFrame:
    """A score for each given ``(donor_id, receiver_id)`` row; other columns stay."""
    d = donors.select(F.col("id").alias("donor_id"), F.col("vec").alias("_d"))
    r = receivers.select(F.col("id").alias("receiver_id"), F.col("vec").alias("_r"))
    return (pairs.join(d, "donor_id").join(r, "receiver_id")
            .withColumn("score", V.dot(F.col("_d"), F.col("_r"))).drop("_d", "_r"))


SLICE_CELLS = 2_000_000  # scores a task holds at a time
_BEST = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def _matrix(batch: pa.RecordBatch, kind: type | None = np.float64) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors as an own copy, of a kind or as they are."""
    ids = batch.column("id").to_numpy().copy()
    values = batch.column("vec").flatten().to_numpy(zero_copy_only=False)
    return ids, values.astype(kind or values.dtype).reshape(len(ids), -1)


def _block(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Candidates in the order of their ids; ``held`` is emptied, so that they stand in memory once."""
    ids = np.concatenate([x for x, _ in held])
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    out, at = np.empty((len(ids), held[0][1].shape[1])), len(ids)
    while held:
        _, values = held.pop()
        at -= len(values)
        out[place[at:at + len(values)]] = values
    return ids[order], out


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row-wise dot products, added in index order, so equal vectors score equal wherever they stand."""
    total = np.zeros(len(q))
    for i in range(q.shape[1]):
        total += q[:, i] * c[:, i]
    return total


def _best_of_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int, exclude_self: bool) -> pa.RecordBatch:
    """The k best candidates of each query; ``c_ids`` ascend.

    The matrix product only preselects, with room for its rounding error; the order is decided on exact scores.
    """
    found = []
    step = max(1, SLICE_CELLS // len(c_ids))
    longest = np.sqrt((c * c).sum(axis=1)).max()
    for start in range(0, len(q_ids), step):
        own_ids, own = q_ids[start:start + step], q[start:start + step]
        cells = own @ c.T
        if exclude_self:
            cells[own_ids[:, None] == c_ids[None, :]] = -np.inf
        floor = np.full(len(own), -np.inf)
        if len(c_ids) > k:
            room = np.sqrt((own * own).sum(axis=1)) * longest * own.shape[1] * 2.0**-50
            floor = np.partition(cells, len(c_ids) - k, axis=1)[:, len(c_ids) - k] - room
        row, col = np.nonzero((cells >= floor[:, None]) & (cells > -np.inf))
        score = _exact(own[row], c[col])
        order = np.lexsort((c_ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        top = np.arange(len(row)) - np.searchsorted(row, row) < k
        found.append((own_ids[row[top]], c_ids[col[top]], score[top]))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=_BEST)


def _cells_top_k(k: int, exclude_self: bool):
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, block = None, [], None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for a, b in zip(bounds, bounds[1:]):
                if a == b:
                    continue
                if cells[a] != cell:
                    cell, held, block = cells[a], [], None
                rows = batch.slice(a, b - a)
                asks = rows.column("asks").to_numpy(zero_copy_only=False)
                n_held = int((~asks).sum())  # the candidates of a cell come first
                if n_held:
                    held.append(_matrix(rows.slice(0, n_held), None))
                if n_held < len(asks) and (held or block):
                    if held:
                        block = _block(held)
                    yield _best_of_block(*_matrix(rows.slice(n_held)), *block, k, exclude_self)

    return best


def top_k(queries: DataFrame, candidates: DataFrame, k: int, exclude_self: bool = False,
          candidate_block: int = 1 << 18) -> DataFrame:
    """``(query_id, rank, id, score)``: the k best dot products per query, ties to the lower id.

    The candidates are cut into blocks of bounded size and enter the shuffle once; the queries
    stream through every block batch by batch, so no task holds more than a block and a batch.
    A block returns k rows per query, never the scored pairs, and a second top-k merges them.
    Where there are fewer blocks than slots, the queries are dealt over copies of these few blocks.
    """
    slots = queries.sparkSession.sparkContext.defaultParallelism
    c_blocks = max(1, math.ceil(candidates.count() / candidate_block))
    deals = max(1, slots // c_blocks)
    float_both = all(df.schema["vec"].dataType.simpleString() == "array<float>" for df in (queries, candidates))
    vec = F.col("vec").cast("array<float>" if float_both else "array<double>").alias("vec")
    id_ = F.col("id").cast("bigint").alias("id")

    def share(n: int):
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def copies(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 1 else F.lit(0)

    held = candidates.select(id_, vec, F.lit(False).alias("asks"), share(c_blocks).alias("cb"), copies(deals).alias("qb"))
    asked = queries.select(id_, vec, F.lit(True).alias("asks"), share(deals).alias("qb"), copies(c_blocks).alias("cb"))
    cell = (F.col("cb") * deals + F.col("qb")).alias("cell")
    dealt = held.unionByName(asked).select("id", "vec", "asks", cell)
    local = (dealt.repartitionById(c_blocks * deals, F.col("cell")).sortWithinPartitions("cell", "asks")
             .mapInArrow(_cells_top_k(k, exclude_self), "query_id long, id long, score double"))
    order = [F.desc("score"), F.asc("id")]
    return (ranked_within(local, "query_id", order).filter(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def top_k_among(queries: DataFrame, vectors: DataFrame, candidates: DataFrame, k: int = 10) -> DataFrame:
    """Top-k restricted to the ids in ``candidates``."""
    return top_k(queries, vectors.join(candidates.select("id").distinct(), "id", "left_semi"), k)


def first_ids(ids: DataFrame, n: int) -> DataFrame:
    """The n lowest ids (ids run from 0, so this is a filter and needs no sort)."""
    return ids.filter(F.col("id") < n)


def similar(vectors: DataFrame, k: int = 5, among_first: int | None = None,
            wanted: DataFrame | None = None) -> DataFrame:
    """The k entities of the same side with the largest dot product, itself left out.

    ``among_first`` restricts the search to the lowest ids, as a quick look.
    """
    pool = vectors if among_first is None else first_ids(vectors, among_first)
    asked = vectors if wanted is None else vectors.join(wanted.select("id"), "id", "left_semi")
    return top_k(asked, pool, k, exclude_self=True)


def vector_profile(vectors: DataFrame) -> DataFrame:
    return vectors.select("id", *V.profile(F.col("vec")))


def recommend(requested: DataFrame, query_ids: DataFrame, query_vectors: DataFrame,
              candidate_ids: DataFrame, candidate_vectors: DataFrame, k: int) -> DataFrame:
    """``(query_ein, rank, ein, score)`` for every requested identifier that is known.

    Serves both directions: donors against all receivers or the reverse.
    Receivers a donor already funds are not left out.
    """
    known = requested.select("ein").distinct().join(query_ids, "ein")
    queries = query_vectors.join(known.select("id"), "id", "left_semi")
    best = top_k(queries, candidate_vectors, k)
    asked = query_ids.select(F.col("id").alias("query_id"), F.col("ein").alias("query_ein"))
    return (best.join(candidate_ids, "id").join(asked, "query_id")
            .select("query_ein", "rank", "ein", "score"))


def recommend_lists(requested: DataFrame, results: DataFrame) -> DataFrame:
    """One row per requested identifier with its ranked list; unknown ones get an empty list."""
    item = F.struct("rank", "ein", "score")
    lists = results.groupBy("query_ein").agg(F.array_sort(F.collect_list(item)).alias("results"))
    empty = F.array().cast("array<struct<rank:int,ein:bigint,score:double>>")
    return (requested.select(F.col("ein").alias("query_ein")).distinct().join(lists, "query_ein", "left")
            .withColumn("results", F.coalesce("results", empty)))


def recommend_one(ein: int, query_ids: DataFrame, query_vectors: DataFrame, candidate_ids: DataFrame,
                  candidate_vectors: DataFrame, k: int) -> DataFrame:
    """Ranked list of a single identifier; an unknown one is an error."""
    row = query_ids.filter(F.col("ein") == ein).select("id").first()
    if row is None:
        raise ValueError(f"identifier {ein} is not in the training data")
    scored = score_against(candidate_vectors, embedding_of(query_vectors, row["id"]))
    best = scored.orderBy(F.desc("score"), "id").limit(k).select("id", "score")
    ranked = ranked_within(best.withColumn("query_ein", F.lit(ein).cast("bigint")), "query_ein", [F.desc("score"), F.asc("id")])
    return ranked.join(candidate_ids, "id").select("query_ein", "rank", "ein", "score")


def analyse(ein: int, ids: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """Vector profile of one identifier with its most similar entities, ``(ein, id, mean, std, norm, head, similar)``.

    ``similar`` is an ordered array of ``(rank, ein, score)``. An unknown identifier gives an empty result.
    """
    own = ids.filter(F.col("ein") == ein)
    best = similar(vectors, k, wanted=own).join(ids, "id").groupBy(F.col("query_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "ein", "score"))).alias("similar"))  # k rows
    return own.select("ein", "id").join(vector_profile(vectors), "id").join(best, "id", "left").select(
        "ein", "id", "mean", "std", "norm", "head", F.coalesce("similar", F.array()).alias("similar"))


def display_lines(results: DataFrame, label: str = "Receiver") -> DataFrame:
    """Results as fixed-width text lines."""
    line = F.format_string(f"%2d. {label} EIN %12d | Score: %7.4f", F.col("rank"), F.col("ein"), F.col("score"))
    return results.select("query_ein", "rank", line.alias("line"))
