"""Shards by k-d tree partitioning.

Documents are points: one coordinate per metadata dimension, measured in ranks so that units
do not matter, and a weight in bytes. A cell that must become k shards is cut along its widest
dimension at the weighted quantile floor(k/2)/k, until every cell is one shard.

Cuts are exact: per level, the cut of every cell is found by summing bytes over ever finer rank
intervals. What comes to the driver is one row per cell, plus at most ``BINS`` sums per pass;
both are bounded by the number of shards, not by the data.

Defined cases: null text has no bytes, and every row counts ``ROW_BYTES`` more; null coordinates
sort first; equal texts are one point, at the least of their coordinates, and share a shard, unless their bytes
alone are more than a quarter of a shard's: then they are dealt by doc_id, each row about a point of its own; ties in
a dimension follow the text's hashes; equal rows are placed one by one; an empty table gives an empty result; a table with fewer rows than shards leaves shards empty; existing
columns named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from almsflow.llm.tables import row_struct
from almsflow.operators.ids import positions
from almsflow.runtime import cut_lineage

ROW_BYTES = 8
#: Sums per pass that come to the driver, over all cells together.
BINS = 16_384
#: Rows of one text are parted if they weigh more than this fraction of a shard.
LARGE = 4


def shards_for(total_bytes: int, target_bytes: int) -> int:
    """How many leaves a corpus needs so that each has about the target."""
    return max(1, -(-total_bytes // target_bytes))


def _cells(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the current cells; one row per cell, so never more rows than shards."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, schema))


def _rank(dim: Column, ranks: list[str]) -> Column:
    out = F.col(ranks[0])
    for number, name in enumerate(ranks[1:], 1):
        out = F.when(dim == number, F.col(name)).otherwise(out)
    return out


def _find_cuts(points: DataFrame, ranks: list[str], goals: dict[int, dict]) -> dict[int, int]:
    """For each cell the last rank that goes left: left bytes come nearest to the goal."""
    done: dict[int, int] = {}
    while goals:
        bins = max(2, BINS // len(goals))
        table = [(cell, g["dim"], g["low"], -(-(g["high"] - g["low"] + 1) // bins)) for cell, g in goals.items()]
        sums = (points.join(_cells(points, table, "_cell int, _dim int, _low long, _step long"), "_cell")
                .withColumn("_bin", F.floor((_rank(F.col("_dim"), ranks) - F.col("_low")) / F.col("_step")))
                .where((F.col("_bin") >= 0) & (F.col("_bin") < bins))
                .groupBy("_cell", "_bin").agg(F.sum("size").alias("bytes")).collect())
        step = {cell: s for cell, _, _, s in table}
        by_cell: dict[int, list[tuple[int, int]]] = {}
        for r in sums:
            by_cell.setdefault(r["_cell"], []).append((r["_bin"], r["bytes"]))
        for cell in list(goals):
            g, below = goals[cell], goals[cell]["below"]
            for number, weight in sorted(by_cell[cell]):
                if below + weight >= g["goal"]:
                    break
                below += weight
            low = g["low"] + number * step[cell]
            if step[cell] == 1:
                near = g["goal"] - below > below + weight - g["goal"]
                done[cell] = low if near else low - 1
                del goals[cell]
            else:
                g.update(low=low, high=min(g["high"], low + step[cell] - 1), below=below)
    return done


def kd_tree(points: DataFrame, ranks: list[str], shards: int) -> DataFrame:
    """Add int ``shard`` to points with rank columns and ``size``."""
    leaves, points = {0: shards}, points.withColumn("_cell", F.lit(0))
    while any(k > 1 for k in leaves.values()):
        spread = [f(r).alias(f"{n}{i}") for i, r in enumerate(ranks) for n, f in (("lo", F.min), ("hi", F.max))]
        open_cells = [(cell,) for cell, k in leaves.items() if k > 1]
        stats = (points.join(_cells(points, open_cells, "_cell int"), "_cell")
                 .groupBy("_cell").agg(F.sum("size").alias("bytes"), *spread).collect())
        goals, after = {}, {cell: k for cell, k in leaves.items() if k == 1}
        for r in stats:
            k = leaves[r["_cell"]]
            widest = max(range(len(ranks)), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
            goals[r["_cell"]] = {"dim": widest, "low": r[f"lo{widest}"], "high": r[f"hi{widest}"], "below": 0,
                                 "goal": r["bytes"] * (k // 2) / k}
        dims = {cell: g["dim"] for cell, g in goals.items()}
        cuts = _find_cuts(points, ranks, goals)
        if not cuts:
            break
        table = [(cell, dims[cell], cut, cell + leaves[cell] // 2) for cell, cut in cuts.items()]
        for cell in cuts:
            k = leaves[cell]
            after[cell], after[cell + k // 2] = k // 2, k - k // 2
        moved = points.join(_cells(points, table, "_cell int, _dim int, _cut long, _right int"), "_cell", "left")
        points = cut_lineage(moved.withColumn("_cell", F.when(_rank(F.col("_dim"), ranks) > F.col("_cut"), F.col("_right"))
                                              .otherwise(F.col("_cell"))).drop("_dim", "_cut", "_right"))
        leaves = after
    return points.withColumnRenamed("_cell", "shard")


#: What tells texts apart: two hashes and the length.
_SAME = ["text_crc32", "_hash", "size"]


def _text_keys() -> list[Column]:
    text = F.coalesce("text", F.lit("")).cast("binary")
    return [F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("_hash"), (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size")]


def _narrow(docs: DataFrame, dims: Sequence[Column]) -> DataFrame:
    """doc_id, size, hashes and coordinates; the texts stay behind."""
    return docs.select(F.col("doc_id").alias("doc_id"), *_text_keys(), *[d.alias(f"_d{i}") for i, d in enumerate(dims)])


def _placed(rows: DataFrame, shards: int, order: Sequence[str]) -> DataFrame:
    """Add shard and slot to rows of ``_narrow``; rows of a shard stand in the order of ``order``."""
    dims = [c for c in rows.columns if c.startswith("_d")]
    rows = cut_lineage(rows.withColumn("_salt", F.xxhash64("doc_id")))
    # One point per text, however many rows have it; the least of their coordinates, null below all.
    low = [F.min(F.struct(F.col(d).isNotNull(), F.col(d))).alias(d) for d in dims]
    groups = cut_lineage(rows.groupBy(*_SAME).agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"), *low))
    total = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    # Only a text whose rows alone would unbalance a shard becomes about as many points as rows.
    is_large = F.col("_bytes") > total / (LARGE * shards)
    large = F.broadcast(groups.where(is_large & (F.col("_rows") > 1)).select(*_SAME, "_rows"))  # LARGE * shards at most
    rows = rows.join(large, _SAME, "left")
    rows = rows.withColumn("_split", F.coalesce(F.pmod(F.col("_salt"), F.col("_rows")) + 1, F.lit(0))).drop("_rows", "_salt", *dims)
    parts = rows.where("_split > 0").groupBy(*_SAME, "_split").agg(F.sum("size").alias("_bytes"))
    whole = groups.where(~(is_large & (F.col("_rows") > 1))).select(*_SAME, F.lit(0).cast("long").alias("_split"), "_bytes", *dims)
    points = whole.unionByName(parts.join(groups.select(*_SAME, *dims), _SAME))
    ranks = []
    for i, dim in enumerate(dims):
        points = positions(points, [F.col(dim), *[F.col(c) for c in _SAME], F.col("_split")], f"_r{i}").drop(dim)
        ranks.append(f"_r{i}")
    tree = kd_tree(points.withColumnsRenamed({"size": "_size", "_bytes": "size"}), ranks, shards).drop(*ranks, "size").withColumnRenamed("_size", "size")
    placed = positions(rows.join(tree, [*_SAME, "_split"]), [F.col(c) for c in ("shard", *order)], "_at")
    # One row per shard.
    first = placed.groupBy("shard").agg(F.min("_at").alias("_first"))
    return placed.join(F.broadcast(first), "shard").withColumn("slot", (F.col("_at") - F.col("_first")).cast("long"))


def assign(docs: DataFrame, dims: Sequence[Column], shards: int) -> DataFrame:
    """Per document: doc_id, size, text_crc32, shard, and slot, its gapless place in the shard by doc_id."""
    return _placed(_narrow(docs, dims), shards, ["doc_id", "text_crc32", "_hash"]).select("doc_id", "size", "text_crc32", "shard", "slot")


def default_dims() -> list[Column]:
    """Length, language and content hash."""
    return [F.octet_length("text").cast("long"), F.col("lang"), F.crc32(F.col("text").cast("binary"))]


def mixing_dims() -> list[Column]:
    """Two draws from the text: every shard gets an even share of everything, and equal texts one shard."""
    return [F.xxhash64(F.lit(seed), F.coalesce("text", F.lit(""))) for seed in (51, 52)]


def with_shards(docs: DataFrame, shards: int, dims: Sequence[Column] | None = None, shuffled: bool = False) -> DataFrame:
    """All columns of the documents plus ``shard`` and ``slot``; ``shuffled`` puts the rows of a shard into hashed order.

    The texts are shuffled once, by identifier and hash; rows that agree in both take the
    places of their group in turn.
    """
    own, key = docs.drop("shard", "slot"), ["id", "text_crc32", "_hash", "size"]
    # A null identifier joins as text "null", which no number is.
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id")
    turn = F.row_number().over(Window.partitionBy(*key).orderBy("size"))
    rows, order = _narrow(docs, dims or default_dims()), ["doc_id", "text_crc32", "_hash"]
    if shuffled:  # copies of a row are told apart by their turn, so hashed order parts them
        rows = rows.withColumn("id", ident).withColumn("_turn", turn).withColumn("_order", F.xxhash64(F.lit(53), *key, "_turn")).drop("id", "_turn")
        order = ["_order", *order]
    places = _placed(rows, shards, order).select(ident, *key[1:], "shard", "slot").groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("shard", "slot"))).alias("places"))
    keyed = own.select(row_struct(own).alias("row"), ident, *_text_keys())
    joined = keyed.join(places, key).withColumn("turn", turn)
    place = F.element_at("places", F.col("turn"))
    return joined.select("row.*", place["shard"].alias("shard"), place["slot"].alias("slot"))
