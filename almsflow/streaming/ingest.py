"""Continuous ingestion: newly landed archives become extracted rows exactly once."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from almsflow.plans.jobs import land_archives
from almsflow.plans.specs import SPECS, Spec
from almsflow.sources.files import LISTING, landed


def run_available(stream: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process everything that has landed since the last run, then stop."""
    return (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to its own folder, so a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def ingest_archives(spark: SparkSession, landing: str, output: str, checkpoint: str,
                    specs: Sequence[Spec] = SPECS, archives_per_batch: int = 500) -> StreamingQuery:
    """Extract newly landed zip archives into ``output``, where :func:`almsflow.plans.jobs.read_extracted` sees them.

    The stream carries listing rows only; archive contents are read inside the batch, chunk by chunk. Every
    micro-batch is a transaction of the extract job's manifest, named by stream and batch, so that a replayed one
    replaces itself and archives that a batch job has taken are left out.
    """
    arrived = (spark.readStream.format("binaryFile").schema(LISTING).option("pathGlobFilter", "*.zip")
               .option("maxFilesPerTrigger", archives_per_batch).load(landing).select("path", "length", "modificationTime"))
    stream = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def extract_batch(batch: DataFrame, batch_id: int) -> None:
        land_archives(landed(batch), output, f"stream-{stream}-{batch_id}", specs)

    return run_available(arrived, extract_batch, checkpoint)
