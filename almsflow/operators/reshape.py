"""Numbered wide columns to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from almsflow.functions.columns import text_when_amount
from almsflow.functions.text import digits_of
from almsflow.operators.relational import drop_placeholders
from almsflow.runtime import cut_lineage

#: Combinations of repeated ids that one piece of a join makes, and partitions of such a join at most.
PIECE, MOST_TASKS = 4_000_000, 20_000
OTHER_INVESTMENTS = "All other program-related investments"  # fixed value


def unpivot_numbered(df: DataFrame, ids: Sequence[str], columns: Sequence[str], value: str,
                     number: str = "num") -> DataFrame:
    """One row per id and numbered column, with the number taken from the column name."""
    long = df.unpivot(list(ids), list(columns), "_source", value)
    return long.withColumn(number, digits_of(F.col("_source"))).drop("_source")


def add_other_pair(df: DataFrame, total: str = "AllOtherProgramRltdInvstTotAmt",
                   text: str = OTHER_INVESTMENTS) -> DataFrame:
    """A third description/expense pair from the 'all other' total, when there is one."""
    return df.withColumns({"Expenses3Amt": F.col(total),
                           "Description3Txt": text_when_amount(F.col(total), text)})


def _combined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` joined with ``right``, the combinations of a key in pieces of about ``PIECE`` rows.

    Both sides may be small and their combinations very many, so the number of tasks follows from these. A key's left rows
    are dealt to its pieces, its right rows go to each of them.
    """
    n = F.count(F.lit(1))
    sizes = (left.groupBy(*keys).agg(n.alias("_l")).join(right.groupBy(*keys).agg(n.alias("_r")), [*keys])
             .select(*keys, F.least(F.col("_l"), F.ceil(F.col("_l") * F.col("_r") / PIECE)).alias("_pieces"), (F.col("_l") * F.col("_r")).alias("_rows")))
    sizes = cut_lineage(sizes)
    slots = left.sparkSession.sparkContext.defaultParallelism
    rows = sizes.agg(F.sum(F.col("_rows").cast("double"))).first()[0] or 0
    width = int(min(max(slots, rows // PIECE), MOST_TASKS))
    sizes = sizes.drop("_rows")
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 31))
    dealt = left.withColumn("_turn", turn).join(sizes, [*keys]).withColumn("_piece", F.col("_turn") % F.col("_pieces")).drop("_turn", "_pieces")
    copied = right.join(sizes, [*keys]).withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces") - 1))).drop("_pieces")
    place = [*keys, "_piece"]
    return dealt.repartition(width, *place).join(copied.repartition(width, *place).hint("merge"), place, "inner").drop("_piece")


def pair_to_rows(df: DataFrame, ids: Sequence[str], descriptions: Sequence[str], expenses: Sequence[str],
                 pairing: str = "row") -> DataFrame:
    """Rows ``(ids, DescriptionTxt, ExpensesAmt)`` from description *n* / expense *n*.

    ``row`` pairs inside each source row in one pass with no shuffle.
    ``melt_join`` unpivots both halves and joins them on ids and number, so an
    id that repeats yields every combination of its rows.
    """
    amount = F.coalesce(F.col("ExpensesAmt").try_cast("double"), F.lit(0.0))
    if pairing == "row":
        pairs = [F.struct(F.col(d).alias("DescriptionTxt"), F.col(e).cast("string").alias("ExpensesAmt"))
                 for d, e in zip(descriptions, expenses, strict=True)]
        long = df.select(*ids, F.inline(F.array(*pairs)))
        return drop_placeholders(long, "DescriptionTxt").withColumn("ExpensesAmt", amount)
    if pairing != "melt_join":
        raise ValueError(f"unknown pairing {pairing!r}")
    left = drop_placeholders(unpivot_numbered(df, ids, descriptions, "DescriptionTxt"), "DescriptionTxt")
    right = unpivot_numbered(df, ids, expenses, "ExpensesAmt").withColumn("ExpensesAmt", amount)
    return _combined(left, right, [*ids, "num"]).select(*ids, "DescriptionTxt", "ExpensesAmt")
