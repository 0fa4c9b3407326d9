"""Exact removal of repeated byte strings: a sparse suffix array with its common-prefix interval tree.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else, in the same text or another. Suffixes
are taken at anchors: in every LENGTH bytes the K-gram with the smallest hash, so equal strings hold the same anchor at
the same place, and comparing the surroundings (LENGTH - K bytes before, LENGTH bytes from it on) of anchors with equal
K-grams finds every repeat. Anchors whose whole surroundings occur twice are settled by a hash of them, which
is all that is shuffled. The rest (the rims of repeats) are laid out as a suffix array per K-gram: sorted by what
follows, with common-prefix lengths; a stack scan yields the intervals of the tree, and in each interval the left
contexts, sorted from the anchor outwards, show where members extend to the left alike and where they differ. Left and
right extents that add up to LENGTH are repeats, for all occurrences of an interval, not just neighbours.

Equal texts are folded first. Anchors are counted by aggregates that combine before the shuffle, never by windows over
a K-gram. The rims of a K-gram with more than MANY_ROWS anchors (counted, not estimated) are not laid out in one task:
their repeats are counted by hashes of all their windows. Defined results: null texts are empty; texts shorter than LENGTH keep all bytes;
repeated rows are copies of each other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.llm.common import forget, slices, stored
from lakeworks.session import shuffle_partitions

LENGTH, GRAM = 200, 32
BEFORE = LENGTH - GRAM
CHUNK = 1 << 19
#: Anchors of one K-gram beyond which its rims are dealt out by windows; bounds the memory of a tree, not the result.
MANY_ROWS = 20_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = 1 << max(12, int(n).bit_length())
    if size not in _powers:
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes:
    """Hashes of any substrings of one piece of text, by prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.down[start])


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, K-gram hashes and hashes of the surroundings of a text's anchors."""
    before, width = length - gram, length - gram + 1
    found: list[tuple[np.ndarray, ...]] = []
    low_bits = np.uint64((1 << 20) - 1)
    for at in range(0, len(data) - length + 1, CHUNK):
        left = max(0, at - before)
        piece = data[left : at + CHUNK + 2 * length]
        hashes = _Hashes(piece)
        skip = at - left
        grams = np.arange(skip, min(len(piece) - gram + 1, skip + CHUNK + before))
        value = hashes.of(grams, grams + gram)
        least = (value & ~low_bits) | (grams - skip).astype(np.uint64)
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if width > reach:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        own = (least & low_bits).astype(np.int64)
        own = own[np.flatnonzero(np.r_[True, own[1:] != own[:-1]])]
        place = own + at
        start, stop = np.maximum(0, place - before), np.minimum(len(data), place + length)
        around = hashes.of(start - left, stop - left)
        shape = ((place - start) * 1024 + (stop - place)).astype(np.uint64)
        found.append((place, value[own], _mix(around ^ (shape * _BASE))))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    place, value, around = (np.concatenate(x) for x in zip(*found, strict=True))
    _, first = np.unique(place, return_index=True)
    return place[first], value[first].view(np.int64), around[first].view(np.int64)


def _prefix(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Common-prefix lengths of the rows of two padded byte tables."""
    differs = a != b
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])
    return np.minimum(common, np.minimum(size_a, size_b))


def _common(a: bytes, b: bytes) -> int:
    """Common-prefix length of two strings, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _table(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    size = np.asarray([len(s) for s in strings], dtype=np.int64)
    joined = b"".join(s.ljust(width, b"\0") for s in strings)
    return np.frombuffer(joined, dtype=np.uint8).reshape(len(strings), width), size


def intervals(common: list[int]) -> list[tuple[int, int, int]]:
    """(common prefix, first, last) of the tree over suffixes whose neighbours share ``common``; children first."""
    out: list[tuple[int, int, int]] = []
    stack = [(0, 0)]
    for i, height in enumerate([*common, -1], start=1):
        first = i - 1
        while stack and stack[-1][0] > height:
            top, first = stack.pop()
            if top > 0 and i - 1 > first:
                out.append((top, first, i - 1))
        if height >= 0 and (not stack or stack[-1][0] < height):
            stack.append((height, first))
    return out


class _Least:
    """Minima of ranges, from minima over powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        levels = [values]
        while len(levels[-1]) > (step := 1 << (len(levels) - 1)):
            levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
        self.table = np.concatenate(levels)
        self.base = np.cumsum([0, *(len(x) for x in levels[:-1])])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Minimum of each range start..stop-1 (not empty)."""
        level = np.frexp((stop - start).astype(np.float64))[1] - 1
        base = self.base[level]
        return np.minimum(self.table[base + start], self.table[base + stop - (1 << level)])


def repeats(left: Sequence[bytes], right: Sequence[bytes], length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(member, bytes to the left, bytes to the right) of every maximal repeat of at least ``length`` bytes.

    ``left`` holds what precedes each anchor, read backwards; ``right`` what begins at it. Left contexts are ranked
    once; within an interval, neighbours by rank extend alike as far as the least common prefix between them.
    """
    before = length - gram
    if len(right) == 2:  # a tree of two leaves
        extend, reach = _common(*left), _common(*right)
        found = reach >= gram and extend + reach >= length
        return [(i, extend, reach) for i in (0, 1)] if found else []
    order = sorted(range(len(right)), key=lambda i: right[i])
    by_left = sorted(range(len(left)), key=lambda i: left[i])
    rank = np.empty(len(left), dtype=np.int64)
    rank[by_left] = np.arange(len(left))
    rank = rank[order]
    r_table, r_size = _table([right[i] for i in order], length)
    l_table, l_size = _table([left[i] for i in by_left], before)
    common = _prefix(r_table[:-1], r_size[:-1], r_table[1:], r_size[1:])
    least = _Least(_prefix(l_table[:-1], l_size[:-1], l_table[1:], l_size[1:]))
    out = []
    for reach, first, last in intervals(common.tolist()):
        if reach < gram:
            continue
        if last == first + 1:
            pair = order[first], order[last]
            extend = _common(left[pair[0]], left[pair[1]])
            out += [(i, extend, reach) for i in pair if extend + reach >= length]
            continue
        inside = np.sort(rank[first : last + 1])
        alike = least.of(inside[:-1], inside[1:])
        extend = np.maximum(np.r_[0, alike], np.r_[alike, 0])  # with its most alike member of the interval
        far = np.flatnonzero(extend + reach >= length)
        out += [(by_left[i], e, reach) for i, e in zip(inside[far].tolist(), extend[far].tolist(), strict=True)]
    return out


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


_BODY = "text"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of each different text of the task."""
    seen: set[tuple[int, int]] = set()
    for batch in slices(batches):
        k1, k2 = batch.column("k1").to_pylist(), batch.column("k2").to_pylist()
        out: list[tuple[np.ndarray, ...]] = []
        for a, b, text in zip(k1, k2, batch.column(_BODY).to_pylist(), strict=True):
            if (a, b) in seen:
                continue
            seen.add((a, b))
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            if len(data) >= LENGTH:
                place, value, around = anchors(data)
                out.append((value, around, np.full(len(place), a), np.full(len(place), b), place))
        if out:
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "around", "k1", "k2", "place"])


def _rows(out: list[tuple], *names: str) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=list(names))


_FOUND = "gram long, around long, k1 long, k2 long, place long"
_PART = "kind int, gram long, before binary, after binary, k1 long, k2 long, lo long, hi long"
FULL, RIM, MANY = 0, 1, 2


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text: merged extents of anchors whose whole surroundings repeat, and the surroundings of its rims."""
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    names = ["kind", "gram", "before", "after", "k1", "k2", "lo", "hi"]
    for batch in slices(batches, 64):
        out: list[tuple] = []
        marks = batch.column("marks")
        kind, gram, place = (pc.struct_field(marks.flatten(), f).to_numpy(zero_copy_only=False) for f in ("kind", "gram", "place"))
        ends = np.cumsum([0, *pc.list_value_length(marks).to_pylist()])
        for i, (a, b) in enumerate(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)):
            data = batch.column(_BODY)[i].as_buffer().to_pybytes()
            own = slice(ends[i], ends[i + 1])
            full = np.sort(place[own][kind[own] == FULL])
            if len(full):
                lo, hi = np.maximum(0, full - BEFORE), np.minimum(len(data), full + LENGTH)
                long = hi - lo >= LENGTH
                lo, hi = lo[long], hi[long]
                new = np.flatnonzero(lo[1:] > hi[:-1]) + 1
                spans = zip(lo[np.r_[0, new]].tolist(), hi[np.r_[new - 1, len(hi) - 1]].tolist(), strict=True) if len(lo) else ()
                out += [(FULL, None, None, None, a, b, *span) for span in spans]
            for j in np.flatnonzero(kind[own] != FULL) + ends[i]:
                at = int(place[j])
                out.append((kind[j], gram[j], data[max(0, at - BEFORE) : at][::-1], data[at : at + LENGTH], a, b, at, None))
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of each K-gram; its rows arrive together. Memory: the rims of one K-gram and a batch."""
    names = ("gram", "before", "after", "k1", "k2", "lo")
    held: list[tuple] = []
    out: list[tuple] = []

    def settle() -> None:
        if len(held) > 1:
            _, before, after, *_ = zip(*held, strict=True)
            for i, lo, hi in repeats(before, after):
                _, _, _, k1, k2, at = held[i]
                out.append((k1, k2, at - lo, at + hi))
        held.clear()

    for batch in slices(batches, 2000):
        for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if held and held[0][0] != row[0]:
                settle()
            held.append(row)
        if out:
            yield _rows(out, "k1", "k2", "lo", "hi")
            out.clear()
    settle()
    yield _rows(out, "k1", "k2", "lo", "hi")


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of every window of LENGTH bytes that holds the anchor."""
    for batch in slices(batches):
        out: list[tuple[np.ndarray, ...]] = []
        for row in batch.to_pylist():
            data = np.frombuffer(row["before"][::-1] + row["after"], dtype=np.uint8)
            start = np.arange(max(0, len(data) - LENGTH + 1))
            twice = [_Hashes(data).of(start, start + LENGTH), _Hashes(data[::-1]).of(len(data) - LENGTH - start, len(data) - start)]
            same = [np.full(len(start), row[k]) for k in ("k1", "k2")]
            out.append((*(h.view(np.int64) for h in twice), *same, start + row["lo"] - len(row["before"])))
        if out:
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["w1", "w2", "k1", "k2", "lo"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each different text."""
    for batch in slices(batches):
        columns: tuple[list, ...] = ([], [], [], [], [], [])
        for a, b, text, copies, spans in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", _BODY, "copies", "spans")), strict=True):
            data = text.encode()
            whole = copies > 1 and len(data) >= LENGTH
            gone = [(0, len(data))] if whole else _merge([(s["lo"], s["hi"]) for s in spans or ()])
            digest, at = hashlib.sha256(), 0
            for lo, hi in gone:
                digest.update(data[at:lo])
                at = hi
            digest.update(data[at:])
            row = (a, b, len(data), sum(hi - lo for lo, hi in gone), [x for s in gone for x in s], digest.hexdigest())
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["k1", "k2", "n_bytes", "n_removed", "bounds", "kept_sha256"],
        )


def _marks(rows: DataFrame) -> DataFrame:
    """k1, k2, marks: the anchors of each text that repeat whole, and one of each kind of surroundings at rims."""
    found = stored(rows.mapInArrow(_anchor_rows, _FOUND))
    per_gram = found.groupBy("gram").agg(
        F.count(F.lit(1)).alias("n"), (F.min("around") != F.max("around")).alias("differ")
    )
    shared = stored(per_gram.where("n > 1"))  # stored, so that the join deals both sides itself and can split a hot K-gram
    hits = stored(found.join(shared, "gram"))
    forget(found)
    forget(shared)
    groups = hits.groupBy("gram", "around").agg(
        F.count(F.lit(1)).alias("same"),
        F.min(F.struct("k1", "k2", "place")).alias("first"),
        F.first("n").alias("n"),
        F.first("differ").alias("differ"),
    )
    groups = stored(groups.where("same > 1 or differ"))  # likewise for hot surroundings
    full = hits.join(groups.where("same > 1").select("gram", "around"), ["gram", "around"])
    kind = F.when(F.col("n") > MANY_ROWS, MANY).otherwise(RIM)
    rims = groups.where("differ").select("first.k1", "first.k2", F.struct(kind.alias("kind"), "gram", "first.place").alias("mark"))
    marks = full.select("k1", "k2", F.struct(F.lit(FULL).alias("kind"), F.lit(0).cast("long").alias("gram"), "place").alias("mark"))
    return marks.union(rims).groupBy("k1", "k2").agg(F.collect_list("mark").alias("marks"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, bounds (starts and ends of what goes, flat), kept_sha256 of every row."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(1), body).alias("k2"), body.alias(_BODY)
    )
    texts = rows.groupBy("k1", "k2").agg(F.first(_BODY).alias(_BODY), F.count(F.lit(1)).alias("copies"))
    held = texts.join(_marks(rows.select("k1", "k2", _BODY)), ["k1", "k2"]).select("k1", "k2", _BODY, "marks")
    parts = stored(held.mapInArrow(_parts, _PART))
    extent = "k1 long, k2 long, lo long, hi long"
    spans = parts.where(F.col("kind") == FULL).select("k1", "k2", "lo", "hi")
    rims = parts.where(F.col("kind") == RIM).drop("kind", "hi").repartition(shuffle_partitions(spark), "gram")
    spans = spans.union(rims.sortWithinPartitions("gram").mapInArrow(_trees, extent))
    windows = parts.where(F.col("kind") == MANY).mapInArrow(_windows, "w1 long, w2 long, k1 long, k2 long, lo long")
    start = F.struct("k1", "k2", "lo")  # one start may come from several anchors
    ends = windows.groupBy("w1", "w2").agg(F.min(start).alias("first"), F.max(start).alias("last"))
    twice = ends.where("first <> last").select("w1", "w2")
    again = windows.join(twice, ["w1", "w2"]).select("k1", "k2", "lo", (F.col("lo") + LENGTH).alias("hi"))
    gone = spans.union(again).groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    left = texts.join(gone, ["k1", "k2"], "left").mapInArrow(
        _cut, "k1 long, k2 long, n_bytes long, n_removed long, bounds array<long>, kept_sha256 string"
    )
    return rows.select("doc_id", "k1", "k2").join(left, ["k1", "k2"]).drop("k1", "k2")


def kept_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the bytes that stay, as binary (a cut may fall inside a character)."""
    spans = repeated_spans(docs, key, text).select(F.col("doc_id").alias("_id"), "bounds").dropDuplicates(["_id"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for body, bounds in zip(batch.column("text").to_pylist(), batch.column("bounds").to_pylist(), strict=True):
                data, ends = (body or "").encode(), [0, *(bounds or ()), None]
                out.append(b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "kept"])

    both = docs.join(spans, docs[key].eqNullSafe(F.col("_id"))).select(
        F.col(key).alias("doc_id"), F.col(text).alias("text"), "bounds"
    )
    return both.mapInArrow(cut, f"doc_id {docs.schema[key].dataType.simpleString()}, kept binary")
