"""CSV datasets of many files, matched to declared columns by name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from almsflow.functions.text import na_to_null
from almsflow.runtime import cut_lineage
from almsflow.schemas import REGISTRY
from almsflow.sources.csvranges import RANGE_BYTES, records

_CORRUPT = "_corrupt"


def _is_bad(schema: T.StructType, required: Sequence[str]) -> Column:
    """A record that does not fit: wrong field count, a value its type cannot
    hold, or a missing required value."""
    tests = [F.col(_CORRUPT).isNotNull()]
    for f in schema.fields:
        c = F.col(f.name)
        if not isinstance(f.dataType, T.StringType):
            tests.append(c.isNotNull() & c.try_cast(f.dataType).isNull())
        if f.name in required:
            tests.append(c.isNull())
    return reduce(lambda a, b: a | b, tests)


def read_csv(spark: SparkSession, directory: str, schema: T.StructType, pattern: str = "*.csv",
             required: Sequence[str] = ("filing_number", "ein", "tax_yr"), bad_file_policy: str = "quarantine",
             with_order: bool = False, range_bytes: int = RANGE_BYTES, keep: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)`` of every non-empty CSV file in a folder; files are read in ranges of ``range_bytes``.

    Columns are found by header name, so files may order them differently or
    lack some. ``quarantine`` sets bad rows aside; ``skip_file`` drops every row
    of a file that has one. ``with_order`` adds ``ord``, a total order over
    (file, position). ``keep`` names a folder that the parsed records are written to, so that files are parsed once for both results.
    """
    if bad_file_policy not in ("quarantine", "skip_file"):
        raise ValueError(f"unknown policy {bad_file_policy!r}")
    required = [f.name for f in schema.fields if f.name in required]
    raw = records(spark, directory, schema.fieldNames(), pattern, range_bytes)
    position = F.struct(F.col("_file").alias("file"), F.col("_first").alias("start"), F.col("_row").alias("row"))
    named = raw.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in schema.fieldNames()], _CORRUPT, position.alias("ord"))
    marked = named.withColumn("_bad", F.coalesce(_is_bad(schema, required), F.lit(False)))
    marked = cut_lineage(marked, keep) if keep else marked
    bad = marked.filter("_bad")
    good = marked.filter("NOT _bad")
    if bad_file_policy == "skip_file":
        files = bad.select(F.col("ord.file").alias("_file")).distinct()
        good = good.join(files, F.col("ord.file") == F.col("_file"), "left_anti")
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    record = F.coalesce(_CORRUPT, F.to_json(F.struct(*schema.fieldNames())))
    return good.select(*columns, *(["ord"] if with_order else [])), bad.select(F.col("ord.file").alias("file"), record.alias("record"))


def read_registry(spark: SparkSession, directory: str, pattern: str = "*.csv", range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected)`` of all regional registry files, rows with ``ord``; an organisation may repeat."""
    return read_csv(spark, directory, REGISTRY, pattern, required=("EIN",), with_order=True, range_bytes=range_bytes)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)
