"""Nearest vectors by blocks: matrix products in doubles, the k best kept while reading."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.session import durable

# Executors need not have this package: the helpers below travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Questions shipped to the tasks at once; more are searched block after block, each with one pass over the vectors.
QUESTION_BYTES = 32 << 20

# Vector-question pairs of one product.
PAIRS = 1 << 21

# Rounding of the product form, as a share of the squared lengths; what it cannot tell apart is measured directly.
ROUNDING = 1e-9


def _blocks(questions: DataFrame, dims: int) -> Iterator[tuple[list, np.ndarray]]:
    """Ids and matrix of one bounded block of questions after another."""
    n = questions.count()
    blocks = max(1, -(-n * dims * 8 // QUESTION_BYTES))
    dealt = durable(questions.repartition(blocks).withColumn("_block", F.spark_partition_id())) if blocks > 1 else questions
    for i in range(blocks):
        rows = (dealt.where(F.col("_block") == i) if blocks > 1 else dealt).select("question_id", "question_vector").collect()
        if rows:
            yield [r[0] for r in rows], np.asarray([r[1] for r in rows], dtype=np.float64)


def _matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that hold a whole finite vector, and their matrix."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), dims), False)
    at = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    flat = pc.list_flatten(column.filter(fits)).to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(-1, dims)
    whole = np.isfinite(matrix).all(axis=1)
    return at[whole], matrix[whole]


def _search(asked: np.ndarray, k: int):
    """Numbers of questions, keys and distances of each task's k best per question."""
    dims, many = asked.shape[1], len(asked)
    lengths = (asked**2).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        question, distance = np.zeros(0, dtype=np.int64), np.zeros(0)
        keys, limit = None, np.full(many, np.inf)
        for batch in batches:
            at, matrix = _matrix(batch.column(1), dims)
            names = batch.column(0).take(pa.array(at))
            keys = names.slice(0, 0) if keys is None else keys
            step = max(1, PAIRS // many)
            for lo in range(0, len(matrix), step):
                rows = matrix[lo : lo + step]
                own = (rows**2).sum(axis=1)
                rough = own[:, None] + lengths - 2 * (rows @ asked.T)
                slack = ROUNDING * (own.max() + lengths)
                near = limit
                if len(rows) > k:
                    near = np.minimum(near, np.partition(rough, k - 1, axis=0)[k - 1] + slack)
                r, q = np.nonzero(rough <= near + slack)
                exact = ((rows[r] - asked[q]) ** 2).sum(axis=1)
                question, distance = np.r_[question, q], np.r_[distance, exact]
                keys = pa.concat_arrays([keys, names.take(pa.array(r + lo))])
                order = np.lexsort((pc.rank(keys).to_numpy(), distance, question))
                question, distance, keys = question[order], distance[order], keys.take(pa.array(order))
                first = np.searchsorted(question, question)
                place = np.arange(len(question)) - first
                full = place == k - 1
                limit[question[full]] = distance[full]
                kept = np.flatnonzero(place < k)
                question, distance, keys = question[kept], distance[kept], keys.take(pa.array(kept))
        if keys is not None and len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(question), keys, pa.array(distance)], names=["_no", "key", "distance"])

    return run


def best_per_task(vectors: DataFrame, questions: DataFrame, k: int, key: str, vector: str) -> DataFrame:
    """question_id, key, distance: the k nearest vectors of each question within each task (squared distances, exact).

    The rows that leave a task are k per question, so the last choice among them is one small shuffle. Vectors that
    are null, of another length than the questions or not finite take no part.
    """
    spark = vectors.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in (*vectors.schema.fields, *questions.schema.fields)}
    settled = durable(questions.where(F.col("question_vector").isNotNull()))
    head = settled.select(F.size("question_vector").alias("n")).head()
    found = None
    for ids, matrix in _blocks(settled, head["n"]) if head else ():
        names = spark.createDataFrame(list(enumerate(ids)), f"_no long, question_id {kinds['question_id']}")
        best = vectors.select(key, vector).mapInArrow(_search(matrix, k), f"_no long, key {kinds[key]}, distance double")
        part = best.join(F.broadcast(names), "_no").select("question_id", F.col("key").alias(key), "distance")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], f"question_id {kinds['question_id']}, `{key}` {kinds[key]}, distance double")
    return found
