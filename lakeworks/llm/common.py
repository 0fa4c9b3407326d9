"""Helpers the operators share: tables, stored frames, ranks without a one-task sort."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeworks.session import read_bytes, shuffle_partitions, work_folder

#: Rows of one rank bucket; only the layout depends on it.
BUCKET_ROWS = 50_000
#: Input bytes that may go to one written file; a partition is never split for it.
FILE_BYTES = 8 << 20
MOST_FILES = 1 << 20  # where the size is unknown, Spark gives an immense one

HELD_OUT_REMAINDER = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few_files(df: DataFrame) -> DataFrame:
    """``df`` in fewer partitions before it is written: several for each core, and one for ``FILE_BYTES`` of what it reads.

    Each file costs a few processes on a file system without native calls, whatever it holds, and each process
    that a JVM starts counts with all of that JVM's memory until it runs its own program.
    """
    read = read_bytes(df)
    if read is None:
        return df
    return df.coalesce(min(MOST_FILES, max(4 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(read / FILE_BYTES))))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: a lost executor cannot change it."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/llm-{uuid.uuid4().hex}"
    few_files(df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a frame made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    hadoop = spark._jsc.hadoopConfiguration()
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(hadoop).delete(folder, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT_REMAINDER, F.lit(False))


def rank_buckets(spark: SparkSession, n: int) -> int:
    """Buckets a hot group is dealt to while ranking: several per task, and more as rows grow."""
    return max(4 * shuffle_partitions(spark), math.ceil(n / BUCKET_ROWS))


def ranked(df: DataFrame, groups: Sequence[str], bucket: Column, order: Sequence[Column], name: str) -> DataFrame:
    """Add the 0-based rank of each row within its group, and the group's rows as ``{name}_total``.

    ``bucket`` must not decrease along ``order``, which is then sorted bucket by bucket: no task sorts a whole
    group. Group columns must not be null. Rows that tie on ``order`` are ranked in any order.
    """
    dealt = df.withColumn("_bucket", bucket)
    keys = [*groups, "_bucket"]
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *keys,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(*groups)).alias(f"{name}_total"),
    )
    local = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1
    placed = dealt.withColumn("_local", local).join(starts, keys)
    return placed.withColumn(name, F.col("_local") + F.col("_start")).drop("_local", "_start", "_bucket")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to a few rows, so that long texts do not pile up as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
