"""Divergence of a language's sources: exact term shares of every (lang, source) group, compared.

``CountVectorizer``, fitted per language with an absolute ``minDF`` and the largest ``vocabSize``,
keeps the terms of at least ``min_docs`` documents and turns every document into an exact sparse
count vector. Vectors are summed per group as sparse vectors, in the tasks that read them and then by source and
block of terms: a group is as large as the terms it uses, where dense buffers would be as large as the vocabulary. Two sources are compared over the terms that either uses;
all other kept terms differ by the same amount, so they are one product.

All numbers are integers: counts are whole, shares are ``1 + floor(10^9 (count + 5) / (N + 5 V))``
by decimal division, distances are sums of longs.

What grows: the vocabulary of a language passes through the driver and is sent to the tasks once, as
``CountVectorizer`` does; ``min_docs`` bounds it, and it grows far slower than the text. The number of
fits is the number of labels that at least ``min_docs`` documents have. Sources are compared in tiles of
``TILE`` x ``TILE`` sources and ``TERMS`` terms, so no task holds a whole language; the pairs themselves
are the result.

Defined cases: null text, lang and source are ''; a group without kept terms takes part with count 0;
a language that keeps no term has pairs of value 0 and no terms; a language of one source has no
pairs; equal values are ordered by item; repeated rows count each time; an empty table gives an empty
result; other columns may have any name and are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from almsflow.llm.tables import arrow_map
from almsflow.runtime import cut_lineage, fresh_path

MIN_DOCS = 30
VOCABULARY = 2**31 - 1
SMOOTH = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Folders of the tokenised documents.
LANG_BUCKETS = 16
#: Sources on each side of a tile and terms in it: at most 2 * 64 * 16,384 longs, 16 MB.
TILE, TERMS = 64, 16_384
#: Entries that a task sums at a time, 16 bytes each.
HELD = 2_000_000
#: More than any term number, and a multiple of TERMS.
VOCABULARY_SPAN = 2**31


def _letter_table() -> np.ndarray:
    """ASCII letters in lower case and bytes beyond ASCII as they are, all else as 0."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 0
    for c in b"abcdefghijklmnopqrstuvwxyz":
        table[c] = table[c - 32] = c
    return table


_LETTERS = _letter_table()


def terms(column: pa.Array) -> pa.Array:
    """Per text its maximal runs of ASCII letters and characters beyond ASCII, only A-Z in lower case; null has none."""
    texts = pa.concat_arrays([column.cast(pa.binary()).fill_null(b"")])
    if texts.offset or not len(texts):
        texts = pa.array(texts.to_pylist(), pa.binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1)
    data = texts.buffers()[2]
    raw = _LETTERS[np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]] if data else np.empty(0, np.uint8)
    bounds = bounds - bounds[0]
    inside = raw > 0
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True  # a term ends with its text
    begins = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    offsets = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int32)
    flat = pa.Array.from_buffers(pa.string(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(begins, bounds), pa.int32()), flat)


def _bucket(lang: Column) -> Column:
    return F.pmod(F.xxhash64(lang), F.lit(LANG_BUCKETS)).cast("int")


def tokenised(docs: DataFrame) -> DataFrame:
    """``(lang, source, terms, bucket)`` of every document, written in a folder per language bucket."""
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    given = docs.select(read("lang").alias("lang"), read("source").alias("source"), F.col("text").cast("string").alias("text"))
    cut = lambda b: pa.RecordBatch.from_arrays([b.column("lang"), b.column("source"), terms(b.column("text"))], names=["lang", "source", "terms"])
    rows = arrow_map(given, cut, "lang string, source string, terms array<string>").withColumn("bucket", _bucket(F.col("lang")))
    path = fresh_path(docs.sparkSession, "terms")
    rows.write.partitionBy("bucket").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def of_language(tokens: DataFrame, lang: str) -> DataFrame:
    """The language's documents; only its bucket is read."""
    return tokens.where((F.col("bucket") == _bucket(F.lit(lang))) & (F.col("lang") == lang)).select("lang", "source", "terms")


def fitted(own: DataFrame, min_docs: int) -> CountVectorizerModel | None:
    """The model of one language's documents, or None where no term is in ``min_docs`` of them."""
    try:
        return CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=VOCABULARY).fit(own)
    except IllegalArgumentException as problem:
        if "vocabulary size" in str(problem):  # the estimator's answer to an empty vocabulary
            return None
        raise


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums by key, keys ascending."""
    flat = np.concatenate(keys)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    begins = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    return flat[begins], np.add.reduceat(np.concatenate(values)[order], begins)


_SUMS = "source string, block int, terms array<int>, counts array<long>"


def _sum_rows(sources: list[str], keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """A row per source and block of ``TERMS`` terms; a key is source number * 2^31 + term."""
    rows = keys // TERMS
    begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    offsets = pa.array(np.append(begins, len(keys)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v, kind)) for v, kind in ((keys % VOCABULARY_SPAN, pa.int32()), (sums, pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array([sources[k] for k in keys[begins] // VOCABULARY_SPAN], pa.string()),
                                       pa.array(rows[begins] % (VOCABULARY_SPAN // TERMS), pa.int32()), *lists], names=["source", "block", "terms", "counts"])


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and how many each row has."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def sparse_sums(vectors: DataFrame) -> DataFrame:
    """``(source, block, terms, counts)``: the sum of each source's document vectors, entries above 0 only.

    Tasks sum what they read, ``HELD`` entries at a time, and the sparse partial sums meet by source and block of terms:
    a source with most documents sends no more rows than any other.
    """
    given = vectors.select("source", F.unwrap_udt("vector").alias("v")).select("source", "v.indices", "v.values")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        keys, values, held = [], [], 0
        for batch in batches:
            owner = np.array([number.setdefault(s, len(number)) for s in batch.column("source").to_pylist()], np.int64)
            flat, sizes = _entries(batch.column("indices"))
            keys.append(np.repeat(owner, sizes) * VOCABULARY_SPAN + flat)
            values.append(_entries(batch.column("values"))[0].astype(np.int64))
            held += len(flat)
            if held >= HELD:
                yield _sum_rows(list(number), *_summed(keys, values))
                number, keys, values, held = {}, [], [], 0
        if held:
            yield _sum_rows(list(number), *_summed(keys, values))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(TERMS, np.int64)

        def summed() -> pa.RecordBatch:
            used = np.flatnonzero(total)
            return _sum_rows([key[0]], used + key[1] * TERMS, total[used])

        for batch in batches:
            columns = [batch.column(c) for c in ("terms", "counts")]
            for i, now in enumerate(zip(batch.column("source").to_pylist(), batch.column("block").to_pylist())):
                if now != key:
                    if key is not None:
                        yield summed()
                    key = now
                    total[:] = 0
                terms, counts = (c[i].values.to_numpy() for c in columns)
                total[terms - key[1] * TERMS] += counts  # a row has a term once
        if key is not None:
            yield summed()

    sums = given.mapInArrow(partial, _SUMS)
    return sums.repartition("source", "block").sortWithinPartitions("source", "block").mapInArrow(merge, _SUMS)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), without rounding."""
    whole = lambda c: c.cast("decimal(20,0)")
    top = whole(count + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)")
    below = whole(total) + whole(kept * F.lit(SMOOTH))
    return F.call_function("div", top, below) + 1


def _extras(lang: str, *found: list[np.ndarray]) -> pa.RecordBatch:
    a, b, extra = (np.concatenate(x) if x else np.empty(0, np.int64) for x in found or ([], [], []))
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(extra, pa.int64())],
                                      names=["lang", "a", "b", "extra"])


def _tile_pairs(rows: DataFrame) -> DataFrame:
    """``(lang, a, b, extra)``: per tile, what the terms that either source uses add to the common difference.

    ``rows`` holds one row per source, term block and tile: base (share of an unused term), side,
    terms and shares. Sources of side 0 meet those of side 1; in a tile of one chunk with itself
    (side 2) every two sources meet.
    """
    schema = "lang string, a int, b int, extra long"

    def compare(lang: str, held: list[tuple]) -> pa.RecordBatch:
        ids = np.array([h[0] for h in held], np.int64)
        base = np.array([h[1] for h in held], np.int64)
        side = np.array([h[2] for h in held])
        flat = np.concatenate([h[3] for h in held])
        if not len(flat):
            return _extras(lang)
        columns, place = np.unique(flat, return_inverse=True)
        owner = np.repeat(np.arange(len(held)), [len(h[3]) for h in held])
        shares = np.repeat(base[:, None], len(columns), axis=1)
        shares[owner, place] = np.concatenate([h[4] for h in held])
        found: tuple[list, list, list] = ([], [], [])
        for i in range(len(held)):
            others = np.flatnonzero((side == 1) if side[i] == 0 else (side == 2) & (ids > ids[i]))
            if side[i] == 1 or not len(others):
                continue
            extra = np.abs(shares[others] - shares[i]).sum(axis=1) - len(columns) * np.abs(base[others] - base[i])
            for out, value in zip(found, (np.full(len(others), ids[i]), ids[others], extra)):
                out.append(value)
        return _extras(lang, *found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("lang", "block", "low", "high"))))
            shares = batch.column("shares")
            for i, (now, number, base, side) in enumerate(zip(keys, *(batch.column(c).to_pylist() for c in ("number", "base", "side")))):
                if now != key:
                    if held:
                        yield compare(key[0], held)
                    key, held = now, []
                entry = shares[i].values
                held.append((number, base, side, *(entry.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("term", "p"))))
        if held:
            yield compare(key[0], held)

    order = ["lang", "block", "low", "high"]
    return rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def pair_distances(groups: DataFrame, entries: DataFrame, chunks: DataFrame) -> DataFrame:
    """``(lang, a, b, value)`` for every two sources a < b of a language, by their numbers.

    ``groups`` has lang, number, base, kept; ``entries`` lang, number, term, p; ``chunks`` per
    language the number of its source chunks.
    """
    chunk = (F.col("number") / TILE).cast("int")
    numbered = groups.join(chunks, "lang").withColumn("chunk", chunk)
    blocks = (entries.withColumn("block", (F.col("term") / TERMS).cast("int")).groupBy("lang", "number", "block")
              .agg(F.collect_list(F.struct("term", "p")).alias("shares")))
    # A chunk meets every chunk of its language, itself included; each meeting has one key.
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    side = F.when(F.col("chunk") == F.col("other"), 2).when(F.col("chunk") < F.col("other"), 0).otherwise(1)
    # Also a source without terms in a block stands there, for the others to be compared with.
    all_blocks = numbered.where("kept > 0").select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("kept") - 1) / TERMS).cast("int"))).alias("block"))
    dealt = (all_blocks.join(blocks, ["lang", "number", "block"], "left").withColumn("shares", F.coalesce("shares", F.array().cast(blocks.schema["shares"].dataType)))
             .select("*", other)
             .select("lang", "block", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                     "number", "base", side.alias("side"), "shares"))
    found = _tile_pairs(dealt)
    extra = found.select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "extra").groupBy("lang", "a", "b").agg(F.sum("extra").alias("extra"))
    # Every pair is a row of the result, also of sources that use no kept term.
    one = numbered.select("lang", "kept", F.col("number").alias("a"), F.col("base").alias("base_a"), F.col("sources"))
    all_pairs = one.select("*", F.explode(F.when(F.col("a") + 1 < F.col("sources"), F.sequence(F.col("a") + 1, F.col("sources") - 1))).alias("b"))
    two = groups.select("lang", F.col("number").alias("b"), F.col("base").alias("base_b"))
    joined = all_pairs.join(two, ["lang", "b"]).join(extra, ["lang", "a", "b"], "left")
    value = F.col("kept") * F.abs(F.col("base_a") - F.col("base_b")) + F.coalesce("extra", F.lit(0))
    return joined.select("lang", "a", "b", value.alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: the other sources of the language by the summed difference of term shares. Part
    ``term``: the ``top_terms`` terms whose share in the source exceeds that in the language most.
    """
    spark = docs.sparkSession
    tokens = tokenised(docs)
    names = tokens.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    named = cut_lineage(names.withColumn("number", number.cast("int")))
    large = [r["lang"] for r in named.groupBy("lang").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang").sort("lang").collect()]

    sums, words = None, None
    for lang in large:
        rows = of_language(tokens, lang)
        model = fitted(rows, min_docs)
        if model is None:
            continue
        own = cut_lineage(sparse_sums(model.transform(rows)).select(F.lit(lang).alias("lang"), "*"))
        vocabulary = spark.createDataFrame(pa.table({"lang": pa.array([lang] * len(model.vocabulary), pa.string()),
                                                     "term": pa.array(range(len(model.vocabulary)), pa.int32()), "item": pa.array(model.vocabulary, pa.string())}))
        vocabulary = cut_lineage(vocabulary)
        sums = own if sums is None else sums.union(own)
        words = vocabulary if words is None else words.union(vocabulary)
    if sums is None:
        sums = spark.createDataFrame([], f"lang string, {_SUMS}")
        words = spark.createDataFrame([], "lang string, term int, item string")

    sums = sums.select("lang", "source", F.explode(F.arrays_zip("terms", "counts")).alias("e")).select("lang", "source", F.col("e.terms").alias("term"), F.col("e.counts").alias("count"))
    kept = words.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    totals = sums.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = (named.join(kept, "lang", "left").join(totals, ["lang", "source"], "left")
              .select("lang", "source", "number", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("total", F.lit(0)).alias("total")))
    base = F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.greatest("kept", F.lit(1)))).otherwise(F.lit(0))
    groups = cut_lineage(groups.withColumn("base", base.cast("long")))
    entries = cut_lineage(sums.join(groups, ["lang", "source"]).withColumn("p", share(F.col("count"), F.col("total"), F.col("kept")))
                          .select("lang", "number", "term", "count", "p"))

    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).cast("int").alias("sources"))
    chunks = sources.select("lang", "sources", F.ceil(F.col("sources") / TILE).cast("int").alias("chunks"))
    near = cut_lineage(pair_distances(groups, entries, chunks))
    both = near.select("lang", F.col("a").alias("number"), F.col("b").alias("other"), "value").union(near.select("lang", "b", "a", "value"))
    label = groups.select("lang", "number", "source")
    pairs = both.join(label, ["lang", "number"]).join(label.select("lang", F.col("number").alias("other"), F.col("source").alias("item")), ["lang", "other"])

    whole = entries.groupBy("lang", "term").agg(F.sum("count").alias("all_count"))
    whole = whole.join(groups.groupBy("lang").agg(F.sum("total").alias("all_total"), F.max("kept").alias("kept")), "lang")
    whole = whole.join(words, ["lang", "term"]).select("lang", "term", "item", share(F.col("all_count"), F.col("all_total"), F.col("kept")).alias("q"))
    above = (entries.join(whole, ["lang", "term"]).where(F.col("p") > F.col("q"))
             .select("lang", "number", "item", (F.col("p") - F.col("q")).alias("value")))

    def ranked(part: str, rows: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("lang", "number").orderBy(F.desc("value"), F.asc("item")))
        return rows.select("lang", "number", F.lit(part).alias("part"), "item", "value", place.alias("rank"))

    best = ranked("term", above).where(F.col("rank") <= top_terms).join(label, ["lang", "number"])
    columns = ["lang", "source", "part", "item", "value", "rank"]
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")).union(best.select(*columns))
