"""Joins, filters and set operations on filings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from almsflow.functions.text import SPACE
from almsflow.schemas import FILING_KEY

# Openings of descriptions that only point elsewhere.
PLACEHOLDERS = ["SEE STATEMENT", "SEE GENERAL EXPLANATION", "(SEE STATEMENT)", "SEE ATTACHMENT", "NONE"]


def left_chain(base: DataFrame, others: Sequence[DataFrame], keys: Sequence[str] = FILING_KEY) -> DataFrame:
    """Left-join tables that hold at most one row per key, one after another.

    All joins share their keys, so the base is shuffled once for the chain.
    """
    return reduce(lambda left, right: left.join(right, list(keys), "left"), others, base)


def survivors(filings: DataFrame, keys: Sequence[str] = FILING_KEY) -> DataFrame:
    return filings.select(*keys).distinct()


def of_survivors(details: DataFrame, filings: DataFrame, keys: Sequence[str] = FILING_KEY) -> DataFrame:
    """Detail rows whose filing survived. A semi join: the key set needs no
    distinct, the detail side is never multiplied, and a filing with very many
    details is split by the adaptive skew join."""
    return details.join(filings.select(*keys), list(keys), "left_semi")


def is_placeholder(description: Column) -> Column:
    # Only as many characters as the longest phrase has are put in upper case.
    opening = F.upper(F.regexp_extract(description, f"(?Us)^{SPACE}*(.{{0,{max(map(len, PLACEHOLDERS))}}})", 1))
    return reduce(lambda a, b: a | b, [opening.startswith(p) for p in PLACEHOLDERS])


def drop_placeholders(df: DataFrame, description: str) -> DataFrame:
    """Keep rows with a description that does not open with a placeholder phrase."""
    return df.filter(F.col(description).isNotNull() & ~is_placeholder(F.col(description)))


def nonempty(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.length(c) > 0 for c in columns]))


def positive(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) > 0 for c in columns]))


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def without_pairs(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key pair is not in ``known``; duplicates in ``df`` stay."""
    return df.join(known.select(*keys), list(keys), "left_anti")
