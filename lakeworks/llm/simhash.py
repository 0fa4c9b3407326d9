"""SimHash near-duplicates under the generalised pigeonhole principle.

A fingerprint takes, bit by bit, the majority over the hashes of all word shingles. Equal fingerprints are folded
first. The 64 bits are grouped into parts of correlated bits; each fingerprint then gets thresholds for its parts that
sum to (limit - parts + 1), chosen by dynamic programming so that the estimated candidates (from counts of the crowded
part values, and an even spread of the rest) and probes are fewest. A link within the limit must agree with one part
within its threshold, so probing each part's ball against an index of part values finds every link. Probes meet the
index inside a task, where distances are verified in blocks; only a spanning forest of the links leaves it.

Defined results: null, empty and word-less texts have fingerprint zero and link like any other; a null id takes part
but is never a component's id; repeated rows fold; an empty table gives an empty result; texts are read whole; further
columns, whatever their names, are kept by ``one_of_each`` and ignored otherwise; ids may be of any type that has an order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import slices, stored
from lakeworks.llm.components import components
from lakeworks.session import shuffle_partitions

SHINGLE, SEED, LIMIT = 4, 42, 4
WIDTHS = (22, 21, 21)
CROWDED = 4096  # at most so many crowded part values are told to all tasks
INDEX_BLOCK = 4096  # index entries of one part value that one task compares
PROBE_COST, CHECK_COST = 50.0, 1.0
PAIRS_AT_ONCE = 1 << 21
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):
        part = np.asarray(hashes[at : at + 4096], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((2 * counts > n).astype(object) @ _POWERS)


_POWERS = np.asarray([1 << i for i in range(64)], dtype=object)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, mark (a hash of the text, to tell rows with one id apart), fp (the fingerprint's bits as a long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bits = np.asarray([fingerprint(t, shingle) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(bits.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "mark", "fp"])

    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, mark long, fp long")


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_order(distinct: DataFrame) -> list[int]:
    """All 64 bits, grouped so that each part holds bits that go together over all fingerprints."""

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64), dtype=np.int64)
        for batch in batches:
            x = _bits(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
            total += np.rint(x.T @ x).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(total.ravel())], names=["cell", "n"])

    n = max(1, distinct.count())
    cells = distinct.select("fp").mapInArrow(together, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    both = np.zeros(4096)
    for r in cells.collect():  # 4,096 rows
        both[r["cell"]] = r["n"] / n
    both = both.reshape(64, 64)
    share = np.diag(both).copy()
    spread = np.sqrt(np.outer(share * (1 - share), share * (1 - share))) + 1e-12
    tie = np.abs((both - np.outer(share, share)) / spread)
    np.fill_diagonal(tie, 0)
    free, order = set(range(64)), []
    for width in WIDTHS:
        inside = sorted(free)
        own = [max(inside, key=lambda i: (tie[i, inside].max(), -i))]
        free.discard(own[0])
        while len(own) < width:
            best = max(sorted(free), key=lambda i: tie[i, own].sum())
            own.append(best)
            free.discard(best)
        order += sorted(own)
    return order


def _balls(width: int, radius: int) -> list[np.ndarray]:
    """Masks of 0, 1, ... radius flipped bits."""
    return [
        np.asarray([sum(1 << i for i in c) for c in combinations(range(width), r)], dtype=np.int64)
        for r in range(radius + 1)
    ]


def thresholds(costs: list[np.ndarray], total: int) -> np.ndarray:
    """For each row, thresholds t >= -1 of the parts with sum of (t + 1) equal to ``total`` and the least cost.

    ``costs[i][:, t + 1]`` is what part i costs at threshold t.
    """
    n = len(costs[0])
    best = np.full((n, total + 1), np.inf)
    best[:, 0] = 0
    picks = []
    for cost in costs:
        after, pick = np.full_like(best, np.inf), np.zeros(best.shape, dtype=np.int64)
        for k in range(min(cost.shape[1], total + 1)):
            sums = best[:, : total + 1 - k] + cost[:, k : k + 1]
            better = sums < after[:, k:]
            after[:, k:] = np.where(better, sums, after[:, k:])
            pick[:, k:] = np.where(better, k, pick[:, k:])
        best = after
        picks.append(pick)
    left, chosen = np.full(n, total), np.zeros((n, len(costs)), dtype=np.int64)
    for i in range(len(costs) - 1, -1, -1):
        chosen[:, i] = picks[i][np.arange(n), left]
        left -= chosen[:, i]
    return chosen - 1


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the links (a, b): no more links than nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        if np.array_equal(low, high):
            break
        np.minimum.at(label, high, low)
        while not np.array_equal(label, label[label]):
            label = label[label]
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def links(distinct: DataFrame, limit: int = LIMIT) -> DataFrame:
    """a, b: links that connect just what all pairs of fingerprints within ``limit`` bits connect."""
    spark = distinct.sparkSession
    n = distinct.count()
    order = bit_order(distinct)
    shifts = np.cumsum((0, *WIDTHS[:-1]))

    def parts(fp: np.ndarray) -> list[np.ndarray]:
        packed = np.packbits(_bits(fp)[:, order], axis=1, bitorder="little")
        moved = np.ascontiguousarray(packed).view("<i8").ravel()
        return [(moved >> s) & ((1 << w) - 1) for s, w in zip(shifts.tolist(), WIDTHS, strict=True)]

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = parts(batch.column(0).to_numpy(zero_copy_only=False))
            bucket = np.concatenate([(i << 24) + v for i, v in enumerate(found)])
            yield pa.RecordBatch.from_arrays([pa.array(bucket)], names=["bucket"])

    # at most CROWDED values can reach this count, as all counts sum to 3 n
    crowded_from = max(16, len(WIDTHS) * n / CROWDED)
    counted = distinct.select("fp").mapInArrow(values, "bucket long").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    crowded = {r["bucket"]: r["n"] for r in counted.where(F.col("n") >= crowded_from).collect()}
    hot = [np.asarray(sorted(b & 0xFFFFFF for b in crowded if b >> 24 == i), dtype=np.int64) for i in range(len(WIDTHS))]
    hot_n = [np.asarray([crowded[(i << 24) + v] for v in h.tolist()], dtype=np.float64) for i, h in enumerate(hot)]
    rest = [(n - h.sum()) / 2**w for h, w in zip(hot_n, WIDTHS, strict=True)]
    radius = min(limit, 3)
    balls = [_balls(w, radius) for w in WIDTHS]
    blocks = {b: math.ceil(c / INDEX_BLOCK) for b, c in crowded.items() if c > INDEX_BLOCK}
    split = np.asarray(sorted(blocks), dtype=np.int64)
    split_n = np.asarray([blocks[b] for b in split.tolist()], dtype=np.int64)

    def cost(i: int, v: np.ndarray) -> np.ndarray:
        near = np.zeros((len(v), radius + 2))
        if len(hot[i]):
            for at in range(0, len(v), 512):
                apart = np.bitwise_count(v[at : at + 512, None] ^ hot[i][None])
                for t in range(radius + 1):
                    near[at : at + 512, t + 1] = (apart <= t) @ hot_n[i]
        probes = np.cumsum([0, *map(len, balls[i])])
        return CHECK_COST * (near + probes * rest[i]) + PROBE_COST * probes

    def spread(bucket: np.ndarray, fp: np.ndarray, role: int) -> tuple[np.ndarray, ...]:
        """Bucket, salt, role and fingerprint; a split bucket's entries are dealt out, its probes visit all blocks."""
        at = np.searchsorted(split, bucket)
        is_split = np.zeros(len(bucket), dtype=bool)
        if len(split):
            is_split = split[np.minimum(at, len(split) - 1)] == bucket
        times = np.ones(len(bucket), dtype=np.int64)
        times[is_split] = split_n[at[is_split]]
        if role == 0:
            salt = (fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % times
            return bucket, salt, np.zeros(len(bucket), dtype=np.int8), fp
        first = np.repeat(np.cumsum(times) - times, times)
        salt = np.arange(int(times.sum())) - first
        return np.repeat(bucket, times), salt, np.ones(len(salt), dtype=np.int8), np.repeat(fp, times)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 2000):
                fp = big.column(0).slice(at, 2000).to_numpy(zero_copy_only=False)
                own = parts(fp)
                chosen = thresholds([cost(i, v) for i, v in enumerate(own)], limit + 1)
                rows = []
                for i, v in enumerate(own):
                    rows.append(spread((i << 24) + v, fp, 0))
                    for t in range(radius + 1):
                        use = chosen[:, i] >= t
                        probe = (v[use][:, None] ^ balls[i][t][None]).ravel()
                        rows.append(spread((i << 24) + probe, np.repeat(fp[use], len(balls[i][t])), 1))
                columns = [np.concatenate(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0].astype(np.int32)), pa.array(columns[1].astype(np.int32)), pa.array(columns[2]), pa.array(columns[3])],
                    names=["bucket", "salt", "role", "fp"],
                )

    dealt = distinct.select("fp").mapInArrow(deal, "bucket int, salt int, role byte, fp long")
    met = dealt.repartition(shuffle_partitions(spark), "bucket", "salt").sortWithinPartitions("bucket", "salt", "role")
    return met.mapInArrow(lambda batches: _verify(batches, limit), "a long, b long")


def _verify(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Probes against the index entries of their bucket; entries come before probes. Memory: a bucket and a batch."""
    kept_key, kept_fp = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for batch in batches:
        bucket, salt, role, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        key = bucket.astype(np.int64) << 32 | salt
        entry = role == 0
        kept_key, kept_fp = np.concatenate([kept_key, key[entry]]), np.concatenate([kept_fp, fp[entry]])
        ask_key, ask = key[~entry], fp[~entry]
        first = np.searchsorted(kept_key, ask_key, side="left")
        size = np.searchsorted(kept_key, ask_key, side="right") - first
        some = size > 0
        ask, first, size = ask[some], first[some], size[some]
        upto = np.cumsum(size)
        at, found = 0, []
        while at < len(ask):
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
            s = size[at:stop]
            offset = np.arange(int(s.sum())) - np.repeat(np.cumsum(s) - s, s)
            a, b = np.repeat(ask[at:stop], s), kept_fp[np.repeat(first[at:stop], s) + offset]
            near = (np.bitwise_count((a ^ b).view(np.uint64)) <= limit) & (a != b)
            if near.any():
                found.append(_forest(a[near], b[near]))
            at = stop
        if found:
            a, b = _forest(*(np.concatenate(x) for x in zip(*found, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        last = kept_key == key[-1] if len(key) else np.zeros(len(kept_key), dtype=bool)
        kept_key, kept_fp = kept_key[last], kept_fp[last]


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, mark, fp, component_id (smallest id that links reach)."""
    rows = stored(fingerprints(docs, key, text, shingle))
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct, limit))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    whole = placed.join(ids, "root").select("fp", F.col("root").alias("component"), "component_id")
    return rows.join(whole, "fp").select("doc_id", "mark", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component with all its columns: the smallest id (null last), then the smallest text hash."""
    whole = docs.select(F.struct(*docs.columns).alias("doc"), F.col(key).alias("doc_id"), F.col(text).alias("text"))
    groups = near_duplicates(whole)
    ident = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    heads = groups.groupBy("component").agg(F.min(ident).alias("head")).select(
        F.col("head.doc_id").alias("head_id"), F.col("head.mark").alias("head_mark")
    )
    rows = whole.withColumn("mark", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("mark") == F.col("head_mark"))
    return rows.join(heads, same, "left_semi").dropDuplicates(["doc_id", "mark"]).select("doc.*")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
