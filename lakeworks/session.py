"""Session settings and the shared folder jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Long documents travel to Python in batches bounded by bytes, not only by rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

_folders: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "lakeworks", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    partitions = cores if isinstance(cores, int) else 8
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a local one only in a local session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="lakeworks-")


def work_folder(spark: SparkSession) -> str:
    """One fresh folder per application below the shared folder."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = f"{checkpoint_root(spark).rstrip('/')}/lakeworks-{app}-{uuid.uuid4().hex[:8]}"
    return _folders[app]


_freeing = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside delete their shuffle files as they end, not when the driver next collects garbage.

    For queries whose result is stored: nothing reads their shuffles again. A Spark without the setting ignores it.
    """
    before = spark.conf.get(_freeing, None)
    spark.conf.set(_freeing, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_freeing)
        else:
            spark.conf.set(_freeing, before)


def durable(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to the shared folder, so that a lost executor cannot change it."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    with shuffles_freed(spark):
        return df.select("*").checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int | None:
    """Spark's own size estimate of a frame; None where the session does not give one."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:  # a remote session has no plan on this side
        return None


def read_bytes(df: DataFrame) -> int | None:
    """Size of the tables a frame reads, by Spark's estimate, each as often as the plan names it; None if not given."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except AttributeError:  # a remote session has no plan on this side
        return None
