"""Exact lexical ranking: best-first inner-product search over sparse ball trees.

A document is the sparse vector of its term impacts, a query the vector of its term weights; the score
is their inner product. Every task builds ball trees over bounded chunks of its documents: a node has a
centre and a radius, and no document below it scores more than ``<q, centre> + |q| * radius`` (Cauchy-Schwarz, with
both sides multiplied by the root of the term's weight, so that common terms hardly widen a ball). The same holds
in every range of terms by itself, so a node also has a radius for each of ``GROUPS`` ranges, the bound is the sum over the
ranges where the query has terms, and what documents have elsewhere does not widen it. A query descends the tree best bound first and stops when the best bound left is
below its k-th score so far; that score is carried from chunk to chunk. Bounds are widened by more than
all rounding of doubles can take off; scores are sums of 64-bit integers at the leaves. The best k of every task are
merged by one window over ``tasks * k`` rows a query.

Only the terms of the queries are kept of a text, because others add nothing to any score; the text is
read once whole. Queries are dealt into blocks of about ``max_terms`` words, so that what goes to the tasks
is bounded; every block passes over all documents.

Defined cases: null text has no terms and is never ranked, nor is a score of 0; queries that repeat id
and text are one query, equal ids with other texts are ranked each by itself; null ids are allowed and come
last among equal scores; repeated document rows are ranked each; a query without terms, an empty
table of either kind and documents without any query term give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from almsflow.llm.decontaminate import normal_words
from almsflow.llm.tables import arrow_map, utf8
from almsflow.runtime import cut_lineage

#: Words of the queries searched in one pass over the documents, about; a single longer query has a pass of its own.
MAX_TERMS = 32_768
#: A tree holds so many documents or term entries; a leaf so many documents at most.
CHUNK_DOCS, CHUNK_ENTRIES, LEAF = 8_192, 500_000, 48
#: Term ranges with a radius of their own.
GROUPS = 1_024
#: Share by which squared radii and bounds are widened. Sums have at most ``MAX_TERMS`` terms or those of one
#: query, and 2^-52 times a million is a quarter of this.
SAFE = 1e-9
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class BallTree:
    """Over sparse rows with values >= 0 whose terms ascend; ``order`` has the rows leaf by leaf.

    Node k has children ``child[k]`` and ``child[k] + 1`` (0: a leaf) and the rows ``order[first[k]:last[k]]``.
    Centres are kept by term and radii by term range, as postings, so that a query's bounds for all nodes are two sums.
    """

    def __init__(self, at: np.ndarray, terms: np.ndarray, values: np.ndarray, width: int):
        self.at, self.terms, self.values, self.width = at, terms, values, width
        self.square = np.add.reduceat(values * values, at[:-1])
        self.groups = min(GROUPS, width)
        self.group = terms.astype(np.int64) * self.groups // width
        self.order = np.arange(len(at) - 1)
        self.first, self.last, self.child = [0], [len(self.order)], [0]
        radius, centres, ranges = [], [], []
        node = 0
        while node < len(self.first):  # children are appended behind, level by level
            a, b = self.first[node], self.last[node]
            rows = self.order[a:b]
            flat, starts = self._entries(rows)
            own, value = terms[flat], values[flat]
            centre = np.bincount(own, value, width) / len(rows)
            away = self._squares(rows, own, value, starts, centre)
            radius.append(np.sqrt(np.max(np.maximum(away, 0) + SAFE * (self.square[rows] + centre @ centre))))
            used = np.flatnonzero(centre)
            centres.append((np.full(len(used), node), used, centre[used]))
            ranges.append((np.full(self.groups, node), np.arange(self.groups), self._radii(flat, starts, own, value, centre)))
            if len(rows) > LEAF and radius[-1] > 0:
                one = self._dense(rows[np.argmax(away)])
                two = self._dense(rows[np.argmax(self._squares(rows, own, value, starts, one))])
                along = np.add.reduceat(value * (one - two)[own], starts)
                self.order[a:b] = rows[np.argsort(along, kind="stable")]
                half = (a + b) // 2
                self.child[node] = len(self.first)
                self.first += [a, half]
                self.last += [half, b]
                self.child += [0, 0]
            node += 1
        self.radius = np.array(radius)
        self.centres, self.ranges = self._postings(centres, width), self._postings(ranges, self.groups)
        flat, starts = self._entries(self.order)
        #: Entry places of the rows in leaf order, and where each row's entries begin.
        self.flat, self.starts = flat, np.append(starts, len(flat))

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.at[rows + 1] - self.at[rows]
        starts = np.cumsum(sizes) - sizes
        return np.repeat(self.at[rows] - starts, sizes) + np.arange(sizes.sum()), starts

    def _squares(self, rows, own, value, starts, centre: np.ndarray) -> np.ndarray:
        """Squared distances of the rows to a point."""
        return self.square[rows] + centre @ centre - 2 * np.add.reduceat(value * centre[own], starts)

    def _radii(self, flat, starts, own, value, centre: np.ndarray) -> np.ndarray:
        """Per term range the largest distance of a row to the centre within the range."""
        group, weight = self.group[flat], centre[own]
        base = np.bincount(np.arange(self.width) * self.groups // self.width, centre * centre, self.groups)
        begins = np.concatenate([[True], group[1:] != group[:-1]])
        begins[starts] = True
        runs = np.flatnonzero(begins)
        # A row without terms in the range is as far away as the centre is long.
        shift, size = np.add.reduceat(value * (value - 2 * weight), runs), np.add.reduceat(value * value, runs)
        out, held = base.copy(), group[runs]
        np.maximum.at(out, held, base[held] + shift + SAFE * (base[held] + size))
        return np.sqrt(np.maximum(out, 0))

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.width)
        out[self.terms[self.at[row]:self.at[row + 1]]] = self.values[self.at[row]:self.at[row + 1]]
        return out

    @staticmethod
    def _postings(parts: list[tuple], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nodes and values by key, and where each key begins."""
        nodes, keys, values = (np.concatenate(p) for p in zip(*parts))
        used = np.flatnonzero(values)
        order = used[np.argsort(keys[used], kind="stable")]
        return nodes[order], values[order], np.searchsorted(keys[order], np.arange(width + 1))

    def _products(self, postings: tuple, keys: np.ndarray, factors: np.ndarray) -> np.ndarray:
        nodes, values, begin = postings
        slices = [slice(begin[k], begin[k + 1]) for k in keys]
        return np.bincount(np.concatenate([nodes[s] for s in slices]), np.concatenate([values[s] * f for s, f in zip(slices, factors)]), len(self.radius))

    def bounds(self, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Per node what no row below it can exceed in its product with the query."""
        in_range = np.sqrt(np.bincount(terms * self.groups // self.width, values * values, self.groups))
        asked = np.unique(terms * self.groups // self.width)
        spread = self._products(self.ranges, asked, in_range[asked])
        return (self._products(self.centres, terms, values) + np.minimum(spread, np.sqrt(values @ values) * self.radius)) * (1 + SAFE)


class Best:
    """The k best documents of one query: higher scores first, then lower ids, null last."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.nulls = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def least(self) -> int:
        """A lower score cannot enter; 1 while there is room."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        enter = scores >= self.least()
        if enter.any():
            scores = np.concatenate([self.scores, scores[enter]])
            ids, nulls = np.concatenate([self.ids, ids[enter]]), np.concatenate([self.nulls, nulls[enter]])
            best = np.lexsort((ids, nulls, -scores))[:self.k]
            self.scores, self.ids, self.nulls = scores[best], ids[best], nulls[best]


class Chunk:
    """A ball tree over documents and their exact impacts."""

    def __init__(self, ids, nulls, at, terms, impacts, weights: np.ndarray):
        self.tree = BallTree(at, terms, np.sqrt(weights[terms]) * impacts, len(weights))
        order, flat = self.tree.order, self.tree.flat
        self.ids, self.nulls, self.terms, self.impacts = ids[order], nulls[order], terms[flat], impacts[flat]

    def search(self, terms: np.ndarray, weights: np.ndarray, exact: np.ndarray, best: Best) -> int:
        """Add the query's best documents; ``exact`` has its weights by term. Returns how many were scored."""
        tree, scored = self.tree, 0
        bounds = tree.bounds(terms, np.sqrt(weights))
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < best.least():
                break
            child = tree.child[node]
            if child:
                heapq.heappush(heap, (-bounds[child], child))
                heapq.heappush(heap, (-bounds[child + 1], child + 1))
                continue
            a, b = tree.first[node], tree.last[node]
            low, high = tree.starts[a], tree.starts[b]
            products = exact[self.terms[low:high]] * self.impacts[low:high]
            best.add(np.add.reduceat(products, tree.starts[a:b] - low), self.ids[a:b], self.nulls[a:b])
            scored += b - a
        return scored


def query_blocks(queries: DataFrame, id_col: str, max_terms: int) -> Iterator[list[tuple]]:
    """The queries as (id, sorted terms), block after block; a block has about ``max_terms`` words."""
    own = queries.select(F.col(id_col).alias("id"), F.col("text").alias("text")).where(F.col("text").isNotNull()).distinct()
    own = own.withColumn("n", F.regexp_count("text", F.lit(_WORD))).where(F.col("n") > 0)
    total = own.agg(F.sum("n")).first()[0] or 0
    n = max(1, -(-total // max_terms))
    for block in range(n if total else 0):
        part = own if n == 1 else own.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block)
        # Bounded by max_terms, but for a single query that is longer.
        rows = [(r["id"], sorted(set(normal_words(r["text"].encode())))) for r in part.select("id", "text").collect()]
        if rows:
            yield rows


def term_vectors(docs: DataFrame, vocabulary: Broadcast, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n, terms, counts)``: words of the whole text, and those of the vocabulary with their numbers."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        number = {t: i for i, t in enumerate(vocabulary.value)}.get
        sizes, at, terms, counts = [], [0], [], []
        for raw in utf8(batch.column("text")):
            found = normal_words(raw)
            sizes.append(len(found))
            own, times = np.unique(np.array([i for i in map(number, found) if i is not None], np.int32), return_counts=True)
            terms.append(own)
            counts.append(times)
            at.append(at[-1] + len(own))
        offsets = pa.array(at, pa.int32())
        flat = lambda parts, kind: pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts), kind))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), flat(terms, pa.int32()), flat(counts, pa.int64())],
                                          names=["doc_id", "n", "terms", "counts"])

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), "text"), count, "doc_id long, n long, terms array<int>, counts array<long>")


def term_weight(total: Column, df: Column) -> Column:
    """floor(1000 ln((2 N + 2) / (2 df + 1)))"""
    return F.floor(F.lit(1000.0) * F.log((2 * total + 2).cast("double") / (2 * df + 1).cast("double"))).cast("long")


def length_norm(n: Column, total: Column, words: Column) -> Column:
    """10 + (90 n N) div L, without overflow."""
    whole = lambda c: c.cast("decimal(18,0)")
    return F.lit(10) + F.call_function("div", F.lit(90).cast("decimal(2,0)") * whole(n) * whole(total), whole(words))


def _search(vectors: DataFrame, queries: Broadcast, weights: Broadcast, k: int) -> DataFrame:
    """``(query, doc_id, score)``: the best k of every task, from ``(doc_id, m, terms, counts)``."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
        held: list[tuple] = []

        def built() -> Chunk:
            ids, nulls, sizes, terms, impacts = (np.concatenate([h[i] for h in held]) for i in range(5))
            return Chunk(ids, nulls, np.concatenate([[0], np.cumsum(sizes)]), terms, impacts, weights.value)

        docs = entries = 0
        for batch in batches:
            column = batch.column("terms")
            sizes = np.diff(column.offsets.to_numpy())
            terms, counts = column.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            m = np.repeat(batch.column("m").to_numpy(), sizes)
            impacts = (1_000_000_000 * counts) // (1000 * counts + 8 * m)
            nulls = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            begin, ends = 0, np.cumsum(sizes)
            while begin < len(ids):  # a batch may hold several chunks
                base = ends[begin - 1] if begin else 0
                stop = min(begin + CHUNK_DOCS - docs, int(np.searchsorted(ends, base + CHUNK_ENTRIES - entries)) + 1, len(ids))
                held.append((ids[begin:stop], nulls[begin:stop], sizes[begin:stop], terms[base:ends[stop - 1]], impacts[base:ends[stop - 1]]))
                docs, entries, begin = docs + stop - begin, entries + int(ends[stop - 1] - base), stop
                if docs >= CHUNK_DOCS or entries >= CHUNK_ENTRIES:
                    yield built()
                    held.clear()
                    docs = entries = 0
        if held:
            yield built()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = weights.value
        best = [Best(k) for _ in queries.value]
        exact = np.zeros(len(weight), np.int64)
        for chunk in chunks(batches):
            for terms, own in zip(queries.value, best):
                exact[terms] = weight[terms]
                chunk.search(terms, weight[terms].astype(float), exact, own)
                exact[terms] = 0
        sizes = [len(b.ids) for b in best]
        if sum(sizes):
            ids = pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.nulls for b in best]))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(best), dtype=np.int32), sizes)), ids, pa.array(np.concatenate([b.scores for b in best]))],
                                             names=["query", "doc_id", "score"])

    return vectors.mapInArrow(run, "query int, doc_id long, score long")


def _ranked_block(docs: DataFrame, block: list[tuple], id_type: str, id_col: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = sorted({t for _, terms in block for t in terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    send = spark.sparkContext.broadcast
    words_sent = send(vocabulary)
    vectors = cut_lineage(term_vectors(docs, words_sent))
    total, words = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for r in frequency.select("term", term_weight(F.lit(total), F.col("df")).alias("w")).collect():  # one row per query term
        weights[r["term"]] = r["w"]
    norm = length_norm(F.col("n"), F.lit(total), F.lit(max(1, words)))
    usable = vectors.where(F.size("terms") > 0).select("doc_id", norm.alias("m"), "terms", "counts")
    queries_sent, weights_sent = send([np.array([number[t] for t in terms], np.int64) for _, terms in block]), send(weights)
    found = _search(usable, queries_sent, weights_sent, k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(block)], f"query int, {id_col} {id_type}")
    out = cut_lineage(top.join(names, "query").select(id_col, "rank", "doc_id", "score"))
    for sent in (words_sent, queries_sent, weights_sent):  # only one block's are alive
        sent.unpersist()
    return out


def rank(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "item_id", max_terms: int = MAX_TERMS) -> DataFrame:
    """Per query its k best documents: query id, rank from 1, doc_id, score."""
    id_type = queries.schema[id_col].dataType.simpleString()
    out = None
    for block in query_blocks(queries, id_col, max_terms):
        found = _ranked_block(docs, block, id_type, id_col, k)
        out = found if out is None else out.union(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], f"{id_col} {id_type}, rank int, doc_id long, score long")
