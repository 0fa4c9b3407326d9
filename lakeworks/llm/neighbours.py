"""Exact nearest vectors by inner product: a block matrix join on int8 codes, then floats for what survives.

Vectors are dealt to tiles (a block of candidates against a block of queries). Inside a tile both sides are coded as
int8 with one scale per vector, the integer products give inner products with a bound on their error (from the norms
of what coding lost), and only candidates whose upper bound reaches the k-th best lower bound are recomputed in double
precision. The best k of each tile are sorted lists, which heaps merge per query.

Defined results: vectors that are null, all zero, or hold a null or a non-finite component take no part, nor do rows
with a null id; of rows that share an id the smallest vector counts; vectors of different length are not compared; a
query meets every other id; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import stored

CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 4096
STEP = 256


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles), dim of the rows that take part, one per id."""
    values = F.col(vector)
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(values, lambda x: x != 0)
    rows = vectors.where(F.col(key).isNotNull() & values.isNotNull() & finite & some)
    one = rows.groupBy(F.col(key).cast("long").alias("vec_id")).agg(F.min(vector).alias("vector"))
    return one.select("vec_id", F.col("vector").cast("array<double>").alias("vector"), F.size("vector").alias("dim"))


def _codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, norm of the coded vector, norm of what coding lost (rounded up a little)."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    back = codes * scale[:, None]
    lost = np.sqrt(((x - back) ** 2).sum(axis=1)) * (1 + 1e-9)
    return codes, scale, np.sqrt((back**2).sum(axis=1)) * (1 + 1e-9), lost


def tile_best(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """The k nearest of one tile for each query, nearest first."""
    if not len(c_ids):
        return
    c_code, c_scale, c_norm, c_lost = _codes(c)
    exact_int = c_code.shape[1] * 127 * 127 < 1 << 24  # then float32 sums of code products are exact
    kind = np.float32 if exact_int else np.float64
    c_mat = c_code.astype(kind).T
    for at in range(0, len(q_ids), STEP):
        ids, part = q_ids[at : at + STEP], q[at : at + STEP]
        code, scale, norm, lost = _codes(part)
        near = (code.astype(kind) @ c_mat).astype(np.float64) * scale[:, None] * c_scale
        error = (norm[:, None] + lost[:, None]) * c_lost + lost[:, None] * c_norm
        error += 1e-9 * (norm[:, None] + lost[:, None]) * (c_norm + c_lost)
        own = ids[:, None] == c_ids
        low = np.where(own, -np.inf, near - error)
        high = np.where(own, -np.inf, near + error)
        take = min(k, len(c_ids))
        floor = -np.partition(-low, take - 1, axis=1)[:, take - 1]
        rows, cols = np.nonzero((high >= floor[:, None]) & ~own)
        score = np.concatenate(
            [(part[rows[i : i + 65536]] * c[cols[i : i + 65536]]).sum(axis=1) for i in range(0, len(rows), 65536)]
            or [np.zeros(0)]
        )
        order = np.lexsort((c_ids[cols], -score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        first = np.searchsorted(rows, np.arange(len(ids)))
        keep = np.arange(len(rows)) - first[rows] < k
        yield pd.DataFrame({"query_id": ids[rows[keep]], "vec_id": c_ids[cols[keep]], "score": score[keep]})


def nearest(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score. ``is_query`` is a condition on the column ``vec_id``."""
    base = stored(usable(vectors, key, vector))
    n = base.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    c_blocks, q_blocks = math.ceil(n["n"] / CANDIDATE_BLOCK) or 1, math.ceil(n["q"] / QUERY_BLOCK) or 1
    draw = F.xxhash64("vec_id")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = base.withColumn("c", F.pmod(draw, F.lit(c_blocks)).cast("int")).withColumn("q", every(q_blocks))
    queries = (
        base.where(is_query)
        .withColumn("q", F.pmod(F.shiftright(draw, 20), F.lit(q_blocks)).cast("int"))
        .withColumn("c", every(c_blocks))
    )

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        q, c = np.stack(left["vector"].to_list()), np.stack(right["vector"].to_list())
        return pd.concat(tile_best(left["vec_id"].to_numpy(), q, right["vec_id"].to_numpy(), c, k))

    tiles = (
        queries.groupBy("dim", "q", "c")
        .cogroup(candidates.groupBy("dim", "q", "c"))
        .applyInPandas(tile, "query_id long, vec_id long, score double")
    )
    lists = tiles.repartition("query_id").sortWithinPartitions("query_id")
    return lists.mapInArrow(lambda batches: _merge(batches, k), "query_id long, rank int, vec_id long, score double")


def _merge(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Keep the k best of each query in a heap; the rows of a query arrive together."""
    heap: list[tuple[float, int]] = []
    current, out = None, []

    def close() -> None:
        best = sorted(heap, key=lambda x: (-x[0], -x[1]))
        out.extend((current, i + 1, -minus, score) for i, (score, minus) in enumerate(best))
        heap.clear()

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
        out.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query_id", "rank", "vec_id", "score"]
        )

    for batch in batches:
        for query, vec, score in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            if query != current:
                close()
                current = query
            if len(heap) < k:
                heapq.heappush(heap, (score, -vec))
            elif (score, -vec) > heap[0]:
                heapq.heapreplace(heap, (score, -vec))
        if len(out) > 10_000:
            yield flush()
    close()
    yield flush()
