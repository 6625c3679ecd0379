"""Dense identifiers and global positions without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from almsflow.runtime import cut_lineage


def positions(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the row's 0-based position in a total order.

    Rows are range-partitioned and sorted; a row's position is its index inside
    its partition plus the sizes of the partitions before. The ranged rows are
    written once, because a re-run of the range sampling could cut elsewhere.
    """
    index = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumns({"_part": F.spark_partition_id(), "_index": index}))
    placed = cut_lineage(ranged)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the line above: bounded by the shuffle's width,
    # whatever the size of the table.
    starts = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
              .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")))
    return (placed.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + F.col("_index")).drop("_part", "_index", "_start"))


def dense_ids(totals: DataFrame, entity: str, amount: str = "grant_amt") -> DataFrame:
    """``(ein, id)``: 0 for the entity with the largest single pair total, ties by identifier.

    This is the order in which entities first appear in the pair list sorted
    by total, since an entity first appears at its largest pair.
    """
    best = totals.groupBy(F.col(entity).alias("ein")).agg(F.max(amount).alias("_best"))
    return positions(best, [F.desc("_best"), F.asc("ein")], "id").select("ein", "id")


def with_ids(edges: DataFrame, donors: DataFrame, receivers: DataFrame) -> DataFrame:
    """Replace identifiers by dense ids on both sides (inner joins: ids cover all edges)."""
    d = donors.select(F.col("ein").alias("donor_ein"), F.col("id").alias("donor_id"))
    r = receivers.select(F.col("ein").alias("receiver_ein"), F.col("id").alias("receiver_id"))
    return edges.join(d, "donor_ein").join(r, "receiver_ein")


def ranked_within(df: DataFrame, group: str, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based rank inside each group of an already small result list."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
