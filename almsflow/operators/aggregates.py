"""Grouped totals, counts and job counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from almsflow.functions import vectors as V
from almsflow.functions.columns import first_present, zero_filled_int


def grant_edges(grants: DataFrame) -> DataFrame:
    """``(donor_ein, receiver_ein, grant_amt)`` totals over usable grants.

    The receiver is the reported identifier, else the inferred one; rows
    without a positive amount and receiver are left out.
    """
    rows = grants.select(
        zero_filled_int(F.col("ein")).alias("donor_ein"),
        zero_filled_int(first_present(F.col("recipient_ein"), F.col("inferred_ein"))).alias("receiver_ein"),
        "grant_amt",
    )
    return pair_totals(rows.filter((F.col("grant_amt") > 0) & (F.col("receiver_ein") > 0)))


def pair_totals(edges: DataFrame) -> DataFrame:
    """Total per donor and receiver, summed as decimals so the order of rows cannot matter."""
    total = F.sum(F.col("grant_amt").cast("decimal(28,6)")).cast("double")
    return edges.groupBy("donor_ein", "receiver_ein").agg(total.alias("grant_amt"))


def largest_first(totals: DataFrame) -> DataFrame:
    return totals.orderBy(F.desc("grant_amt"), "donor_ein", "receiver_ein")


def grand_total(edges: DataFrame) -> DataFrame:
    return edges.agg(F.sum(F.col("grant_amt").cast("decimal(28,6)")).cast("double").alias("grant_total"))


def entity_counts(edges: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct donors and receivers. Exact counts aggregate twice
    (distinct values first), so no task ever holds a whole column's values."""
    if approximate:
        return edges.agg(F.approx_count_distinct("donor_ein").alias("n_donors"),
                         F.approx_count_distinct("receiver_ein").alias("n_receivers"))
    return edges.agg(F.count_distinct("donor_ein").alias("n_donors"),
                     F.count_distinct("receiver_ein").alias("n_receivers"))


def rows_per(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def first_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column) -> DataFrame:
    """Per key, the first non-null value of each column in ``order``."""
    return df.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])


def match_rate(matched: DataFrame, ein: str = "inferred_ein") -> DataFrame:
    total, hits = F.count(F.lit(1)), F.count(ein)
    return matched.agg(hits.alias("matched"), total.alias("total"),
                       F.round(hits / total * 100, 1).alias("percent"))


def match_breakdown(matched: DataFrame) -> DataFrame:
    return (rows_per(matched.filter("match_type IS NOT NULL"), "match_type")
            .orderBy(F.desc("n"), "match_type"))


def split_metrics(scored: DataFrame, *by: str) -> DataFrame:
    """Mean logistic loss and accuracy of ``(score, label)`` rows."""
    label = F.col("label").cast("double")
    measures = (F.avg(V.logistic_loss(F.col("score"), label)).alias("loss"),
                F.avg((V.predicted(F.col("score")) == F.col("label")).cast("double")).alias("accuracy"))
    return scored.groupBy(*by).agg(*measures) if by else scored.agg(*measures)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter filled as a side product of the job that uses it."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
