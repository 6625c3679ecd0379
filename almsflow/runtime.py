"""Session defaults and the places where a job touches shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("almsflow")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="almsflow-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: there the
    driver and the executors are one machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="almsflow-"))
    return sc.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def no_leftovers(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write or an action inside go when it has ended, and not when the driver next collects its garbage.

    Only for what is run once: a plan that runs again would have to make them again.
    """
    before = spark.conf.get(_CLEANUP_CONF, None)
    spark.conf.set(_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_CONF)
        else:
            spark.conf.set(_CLEANUP_CONF, before)


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written copy.

    Used where a result feeds several later steps or an iteration: the copy
    outlives executors, so a lost one never replays the whole history. Who names the
    ``path`` of the copy may :func:`remove` it when nothing reads it any more.
    """
    path = path or fresh_path(df.sparkSession, "stage")
    with no_leftovers(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the caller has written and that nothing will read again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
