"""Parquet tables: datasets, identifier maps."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from almsflow.operators.aggregates import counted
from almsflow.runtime import cut_lineage, no_leftovers
from almsflow.sources.files import exists, replace_file


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    with no_leftovers(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


REPORT = "job string, dataset string, rows long, written_at timestamp"


def write_counted(df: DataFrame, path: str, report: str, job: str, name: str) -> int:
    """Write a table and add its number of rows, counted on the way, to the report table of the job's output."""
    rows, seen = counted(df, f"{job}_{name}")
    write_table(rows, path)
    n = int(seen.get.get("rows", 0))  # a plan known to be empty has no counter
    add_to_report(df.sparkSession, report, job, {name: n})
    return n


def add_to_report(spark: SparkSession, report: str, job: str, counts: Mapping[str, int]) -> None:
    rows = spark.createDataFrame([(job, name, n) for name, n in counts.items()], "job string, dataset string, rows long")
    rows.coalesce(1).withColumn("written_at", F.current_timestamp()).write.mode("append").parquet(report)


def last_report(spark: SparkSession, report: str) -> DataFrame:
    """``(job, dataset, rows)`` as counted by the latest run of every job."""
    rows = read_or_empty(spark, report, REPORT)
    return rows.groupBy("job", "dataset").agg(F.max_by("rows", "written_at").alias("rows"))


def save_ids(donors: DataFrame, receivers: DataFrame, path: str) -> None:
    """Both ``(ein, id)`` tables; the reverse map is the same table joined the other way."""
    write_table(donors, f"{path}/donor_ids")
    write_table(receivers, f"{path}/receiver_ids")


def load_ids(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    schema = T.StructType([T.StructField("ein", T.LongType()), T.StructField("id", T.LongType())])
    return tuple(read_table(spark, f"{path}/{name}_ids", schema=schema) for name in ("donor", "receiver"))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one where nothing has been written yet."""
    return spark.read.schema(schema).parquet(path) if exists(path) else spark.createDataFrame([], schema)


def write_extracted(rows: DataFrame, path: str, run: str, fields: Sequence[str]) -> None:
    """Extracted rows as one folder per run and dataset, every field a column of its own.

    A dataset's rows are null in the fields of others, which Parquet stores for next to nothing,
    and a reader of one dataset reads only its folders and the columns it names. A run that is
    repeated replaces its folder.
    """
    own = [F.col("fields")[f].alias(f) if "fields" in rows.columns else F.col(f) for f in fields]
    named = rows.withColumn("dataset", F.coalesce("dataset", F.lit("quarantined")))
    with no_leftovers(rows.sparkSession):
        (named.select("seq", "filing_number", "zip_name", "ein", "tax_yr", "form", "member", "error", *own, "dataset")
         .write.mode("overwrite").partitionBy("dataset").parquet(f"{path}/run={run}"))


EXPORTED = "dataset string, zip_name string, file string, rows long"


def export_files(rows: DataFrame, path: str, columns: Mapping[str, Sequence[str]], form: str = "csv") -> DataFrame:
    """One file ``{dataset}__{archive}.csv`` (or ``.parquet``) per dataset and archive; returns what was written.

    ``rows`` has dataset, zip_name, member, seq and the columns that ``columns`` lists per dataset, as text. Files are
    written as a stream, in member order, and appear whole or not at all; a repeated export replaces them.
    """
    if form not in ("csv", "parquet"):
        raise ValueError(f"unknown form {form!r}")
    # A scan per dataset reads its own columns alone, and its rows travel as lists of these.
    parts = [rows.filter(F.col("dataset") == name).select("dataset", F.col("zip_name").alias("_archive"), "member", "seq",
                                                          F.array(*[F.col(c).cast("string") for c in own]).alias("_values"))
             for name, own in columns.items()]
    dealt = reduce(DataFrame.unionByName, parts).repartition("dataset", "_archive").sortWithinPartitions("dataset", "_archive", "member", "seq")

    def export(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, count, open_file, sink, schema = None, 0, None, None, None

        def close() -> pa.RecordBatch:
            sink.close()
            open_file.__exit__(None, None, None)
            return pa.RecordBatch.from_pylist([{"dataset": key[0], "zip_name": key[1], "file": file_of(key), "rows": count}],
                                              pa.schema([("dataset", pa.string()), ("zip_name", pa.string()), ("file", pa.string()), ("rows", pa.int64())]))

        def file_of(key: tuple[str, str]) -> str:
            return f"{key[0]}__{key[1].removesuffix('.zip')}.{form}"

        try:
            for batch in batches:
                keys = list(zip(batch.column("dataset").to_pylist(), batch.column("_archive").to_pylist()))
                start = 0
                for i in range(1, len(keys) + 1):
                    if i < len(keys) and keys[i] == keys[start]:
                        continue
                    if keys[start] != key:
                        if key is not None:
                            yield close()
                        key, count = keys[start], 0
                        open_file = replace_file(f"{path}/{file_of(key)}")
                        stream, schema = open_file.__enter__(), pa.schema([(c, pa.string()) for c in columns[key[0]]])
                        sink = pacsv.CSVWriter(stream, schema) if form == "csv" else pq.ParquetWriter(stream, schema)
                    values, width = batch.column("_values").slice(start, i - start).flatten(), len(columns[key[0]])
                    places = np.arange(0, len(values), width)
                    sink.write_table(pa.table([values.take(pa.array(places + k)) for k in range(width)], schema))
                    count, start = count + i - start, i
            if key is not None:
                yield close()
                key = None
        except BaseException as problem:
            if open_file is not None and key is not None:  # an unfinished file is never seen
                try:
                    open_file.__exit__(type(problem), problem, problem.__traceback__)
                except BaseException:
                    pass
            raise

    return cut_lineage(dealt.mapInArrow(export, EXPORTED))
