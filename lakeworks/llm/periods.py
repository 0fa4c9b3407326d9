"""Runs: maximal periodic stretches of words, by internal pattern matching.

A stretch with period q and at least 2q words holds an aligned block of a power of two words whose next copy stands q
words further on. For every such block the copies in the neighbouring window are found in the suffix array, by
range-successor queries to a wavelet tree over it (the least position from a given one on within the block's interval of
suffixes). Copies that overlap by half form an arithmetic progression, which is followed in one step; a
progression within the block's own periodic stretch only repeats multiples of its period and is left after its first
member. Distances to copies are candidate periods; each is extended to both sides as far as the period holds.

Documents of a task are searched together: words are numbered per document, so no match crosses documents. All
tables are arrays over the words of such a batch (at least ``BATCH_WORDS`` words, or one longer text).

Defined results: null, empty and word-less texts have no run, null figures and the digest of nothing twice; a null
id changes no word; repeated rows are separate rows; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import slices
from lakeworks.llm.suffixes import Suffixes

LEAST = 12
BATCH_WORDS = 1 << 17


class Wavelet:
    """Wavelet tree over a permutation (levels kept as one matrix): counts and order statistics of slot ranges."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1 == 1
            self.zeros.append(np.r_[0, np.cumsum(~one)])
            values = np.concatenate([values[~one], values[one]])

    def _less(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        less = np.zeros(len(lo), dtype=np.int64)
        for level, zeros in enumerate(self.zeros):
            one = (value >> (self.bits - 1 - level)) & 1 == 1
            left, right = zeros[lo], zeros[hi]
            less += np.where(one, right - left, 0)
            lo, hi = np.where(one, zeros[-1] + lo - left, left), np.where(one, zeros[-1] + hi - right, right)
        return less

    def _smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        value = np.zeros(len(lo), dtype=np.int64)
        for level, zeros in enumerate(self.zeros):
            left, right = zeros[lo], zeros[hi]
            one = k >= right - left
            k = np.where(one, k - (right - left), k)
            value += one * (1 << (self.bits - 1 - level))
            lo, hi = np.where(one, zeros[-1] + lo - left, left), np.where(one, zeros[-1] + hi - right, right)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The least value of slots lo..hi-1 that is at least ``value`` (below 2 ** bits); -1 if there is none."""
        less = self._less(lo, hi, value)
        out = np.full(len(lo), -1, dtype=np.int64)
        there = np.flatnonzero(less < hi - lo)
        out[there] = self._smallest(lo[there], hi[there], less[there])
        return out


def _windows(suffixes: Suffixes) -> Iterator[tuple[int, int, int, int]]:
    """(level, block length, first and last distance) such that every run is met: see the bounds below.

    A run of length m >= max(LEAST, 2q) repeats m - q words q further on, and a stretch of 2b - 1 words holds an
    aligned block of b. So blocks of 4 serve q up to 14 but 6, where LEAST - q is below 7 and blocks of 2 are taken.
    """
    for level in range(1, len(suffixes.ranks)):
        block = 1 << level
        first, last = {1: (6, 6), 2: (1, 14)}.get(level, (2 * block - 1, 4 * block - 2))
        yield level, block, first, last


def _candidates(suffixes: Suffixes, tree: Wavelet) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of blocks and distances to copies of them."""
    n = len(suffixes.order)
    for level, block, first, last in _windows(suffixes):
        rank, size = suffixes.ranks[level], suffixes.sizes(level)
        at = np.arange(0, n - block + 1, block)
        at = at[(size[rank[at]] > 1) & (at + first < n)]
        since, until = at + first, np.minimum(at + last, n - 1)
        while len(at):
            lo = rank[at]
            hi = lo + size[lo]
            copy = tree.successor(lo, hi, since)
            found = np.flatnonzero((copy >= 0) & (copy <= until))
            at, lo, hi, copy, until = at[found], lo[found], hi[found], copy[found], until[found]
            if not len(at):
                break
            yield at, copy - at
            after = np.full(len(at), -1, dtype=np.int64)
            more = np.flatnonzero(copy < until)
            after[more] = tree.successor(lo[more], hi[more], copy[more] + 1)
            step = after - copy
            last_copy = copy.copy()
            row = np.flatnonzero((after >= 0) & (after <= until) & (2 * step <= block))
            if len(row):
                b, c, d = at[row], copy[row], step[row]
                members = (d + suffixes.ahead(c, c + d) - block) // d
                members = np.minimum(members, (until[row] - c) // d)
                last_copy[row] = c + members * d
                own = b + d + suffixes.ahead(b, b + d) >= c + block  # the block's own stretch of period d
                b, c, d, members = (x[~own] for x in (b, c, d, members))
                times = np.arange(members.sum()) - np.repeat(np.cumsum(members) - members, members) + 1
                yield np.repeat(b, members), np.repeat(c - b, members) + times * np.repeat(d, members)
            since = last_copy + 1
            rest = np.flatnonzero(since <= until)
            at, since, until = at[rest], since[rest], until[rest]


def runs(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and smallest periods of all runs of at least max(LEAST, 2 * period) numbers, in order."""
    none = np.zeros(0, dtype=np.int64)
    if len(numbers) < LEAST:
        return none, none, none
    suffixes = Suffixes(numbers)
    if len(suffixes.ranks) < 2:
        return none, none, none
    found = []
    for at, distance in _candidates(suffixes, Wavelet(suffixes.order)):
        start = at - suffixes.behind(at, at + distance)
        end = at + distance + suffixes.ahead(at, at + distance)
        long = end - start >= np.maximum(LEAST, 2 * distance)
        found.append((start[long], end[long], distance[long]))
    if not found:
        return none, none, none
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # Of one stretch only its smallest period counts; multiples of it were met as well.
    first = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else np.zeros(0, dtype=bool)
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def planted(words: list[bytes], key: str | None) -> list[bytes]:
    """The words with a periodic tail where the CRC-32 of the id ends in 0; the tail's place and period follow from it."""
    n = len(words)
    code = crc32(key.encode()) if key is not None else 1
    if not n or code % 10:
        return words
    g = code // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    times = -(-(n - a) // len(cycle))
    return words[:a] + (cycle * times)[: n - a]


def _figures(words: list[bytes], start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple:
    """The digest columns of one document from its runs (by start, then period)."""
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in zip(start.tolist(), end.tolist(), period.tolist(), strict=True))
    best: tuple = (None, None, None, None)
    kept = words
    if len(start):
        length = end - start
        i = np.lexsort((period, start, -length))[0]
        best = (int(start[i]), int(length[i]), int(period[i]), 1000 * int(length[i]) // int(period[i]))
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(depth, start + period, 1)
        np.add.at(depth, end, -1)
        stay = np.cumsum(depth[:-1]) == 0
        kept = [words[i] for i in np.flatnonzero(stay).tolist()]
    return len(start), *best, sha256(listed.encode()).hexdigest(), sha256(b" ".join(kept)).hexdigest()


_COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def _settled(keys: Sequence, texts: list[list[bytes]]) -> Iterator[tuple]:
    """Figures of a batch of documents, searched together."""
    bounds = np.cumsum([0, *map(len, texts)])
    numbers = np.empty(bounds[-1], dtype=np.int64)
    for i, words in enumerate(texts):
        seen: dict[bytes, int] = {}
        base = int(bounds[i])
        numbers[base : bounds[i + 1]] = [base + seen.setdefault(w, len(seen)) for w in words]
    start, end, period = runs(numbers)
    cuts = np.searchsorted(start, bounds)
    for i, (key, words) in enumerate(zip(keys, texts, strict=True)):
        own = slice(cuts[i], cuts[i + 1])
        yield (key, *_figures(words, start[own] - bounds[i], end[own] - bounds[i], period[own]))


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """doc_id, the number of runs, the longest one and two digests; ``plant`` first gives every tenth text a tail."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            columns = list(zip(*_settled(keys, texts), strict=True))
            types = [id_type, *[pa.int64()] * 5, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", *_COLUMNS])

        keys: list = []
        texts: list[list[bytes]] = []
        held, id_type = 0, None
        for batch in slices(batches):
            id_type = batch.schema.field("doc_id").type
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("_name").to_pylist(), batch.column("_text"), strict=True)
            for name, label, body in rows:
                words = body.as_buffer().to_pybytes().split() if body.is_valid else []
                words = planted(words, label) if plant else words
                keys.append(name)
                texts.append(words)
                held += len(words)
                if held >= BATCH_WORDS:
                    yield out()
                    keys, texts, held = [], [], 0
        if keys:
            yield out()

    rows = docs.select(F.col(key).alias("doc_id"), F.col(key).cast("string").alias("_name"), F.col(text).alias("_text"))
    return rows.mapInArrow(search, schema)
