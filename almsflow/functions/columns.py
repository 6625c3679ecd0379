"""Projection helpers: rename, cast, fill, label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T


def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep the mapped columns under their new names, matched by name and never by position."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def cast_to(df: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Cast columns to ``schema``; strict casts fail the job, lenient ones give null."""
    def one(field: T.StructField) -> Column:
        c = F.col(field.name)
        return (c.cast(field.dataType) if strict else c.try_cast(field.dataType)).alias(field.name)

    return df.select(*[one(f) for f in schema.fields])


def first_present(*cols: Column) -> Column:
    return F.coalesce(*cols)


def fill_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.fillna(0, subset=columns) if columns else df.fillna(0)


def zero_filled_int(c: Column) -> Column:
    return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))


def text_when_amount(amount: Column, text: str) -> Column:
    """``text`` where the amount is present and not zero, else null."""
    return F.when(F.coalesce(amount, F.lit(0)) != 0, F.lit(text))
