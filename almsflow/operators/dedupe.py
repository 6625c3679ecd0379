"""Keep one row per key under an explicit total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key.

    The rank filter is planned as a group limit before *and* after the shuffle,
    so each map task ships at most one row per key: a key holding most of the
    table costs one row per task, not one huge sort.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def keep_largest(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Per key, the row with the largest ``by``; null loses to any value.

    Ties go to the greater ``zip_name`` where there is one, then to the greater
    value of the remaining columns in table order.
    """
    rest = [c for c in df.columns if c not in keys and c != by]
    rest.sort(key=lambda c: c != "zip_name")
    return keep_first(df, keys, [F.col(c).desc_nulls_last() for c in [by, *rest]])


def latest_filings(filings: DataFrame) -> DataFrame:
    """The newest filing of each organisation, year and form."""
    return keep_largest(filings, ["ein", "tax_yr", "form"], "filing_number")


def largest_amounts(amounts: DataFrame, by: str) -> DataFrame:
    """One amounts row per filing: nulls become 0 first, so a null beats a negative."""
    from almsflow.schemas import FILING_ID

    return keep_largest(amounts.fillna(0), FILING_ID, by)


def greatest_text(texts: DataFrame, by: str) -> DataFrame:
    """One text row per filing: the greatest text in code-point order, null last."""
    from almsflow.schemas import FILING_ID

    return keep_largest(texts, FILING_ID, by)
