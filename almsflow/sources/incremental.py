"""Process each landed input once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F



def pending(inputs: DataFrame, manifest: DataFrame, key: str | Sequence[str] = "name", force: bool = False) -> DataFrame:
    """Inputs the manifest does not list; with ``force`` all of them.

    A single key is compared with the manifest's ``name``, several with its columns of the same
    names. An input enters the manifest only after its output is committed, so a run that died
    half-way is repeated, not taken for done.
    """
    if force:
        return inputs
    if isinstance(key, str):
        return inputs.join(manifest.select(F.col("name").alias(key)), key, "left_anti")
    return inputs.join(manifest.select(*key), [*key], "left_anti")


def committed(processed: DataFrame, key: str = "name", *carried: str) -> DataFrame:
    """Manifest rows for inputs whose output has been written."""
    return (processed.select(F.col(key).alias("name"), *carried).distinct()
            .withColumn("committed_at", F.current_timestamp()))
