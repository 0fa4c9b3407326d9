"""Removal of repeated word windows by relative Lempel-Ziv parsing.

A word goes if a window of ``WINDOW`` words that covers it starts anywhere else, in the same text or another.

Reference blocks are dealt by content: in every window the GRAM-word sequence with the smallest hash is its anchor, so
equal windows have the same anchor at the same place, and the pieces of text around equal anchors (the words any window
with that anchor can reach) meet in one block. There they are indexed by a suffix array, and every piece is
parsed greedily into its longest factors that stand elsewhere in the block. Windows inside a factor of WINDOW words or
more are repeats; windows across a factor boundary are looked up by themselves, since a greedy parse may cut them.

Equal texts are folded, and so are equal pieces: one that stands twice is a single factor and marks all its places.
Pieces around an anchor are counted (by aggregates that combine before the shuffle). Where different ones are more than
a block takes, the anchor is widened: a window reaches half of the remaining words to the left or to the right of it, so
each piece goes on under a longer anchor to either side, with less around it; more pieces are then equal and fold, until
an anchor fills a whole window. Both sides of every join by anchor are stored tables, so that a hot anchor can be split
when the join runs. Nothing is capped or sampled.

Defined results: null, empty and word-less texts have no words and the digest of nothing; texts shorter than a window
keep all words; repeated rows are copies of each other; a null id takes part like any other; an empty table gives an
empty result; further columns are ignored; texts are parsed whole, however long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import forget, slices, stored
from lakeworks.llm.suffixes import Suffixes
from lakeworks.session import shuffle_partitions

WINDOW, GRAM = 35, 8
SLACK = WINDOW - GRAM
#: Different pieces one anchor may bring to a block; anchors with more are widened. Bounds memory, not the result.
BLOCK_PIECES = 2_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def anchors(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a text's anchors, given the hashes of its words."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    value = np.zeros(n - gram + 1, dtype=np.uint64)
    for j in range(gram):
        value = value * _BASE + hashes[j : j + len(value)]
    value = _mix(value)
    width = window - gram + 1
    # The leftmost least hash of each window: places are ranked by (hash, place), and the least rank wins.
    order = np.argsort(value, kind="stable")
    least = np.empty(len(value), dtype=np.int64)
    least[order] = np.arange(len(value))
    reach = 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if width > reach:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    place = order[least[np.r_[True, least[1:] != least[:-1]]]]
    return place, value[place]


def _range_hashes(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Hashes of the word ranges start..stop-1, told apart by ``shape`` as well."""
    up = np.full(len(hashes) + 1, _BASE, dtype=np.uint64)
    down = np.full(len(hashes) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)), dtype=np.uint64)
    up[0] = down[0] = 1
    np.cumprod(up, out=up)
    np.cumprod(down, out=down)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], out=sums[1:])
    return _mix(_mix((sums[stop] - sums[start]) * down[start]) ^ (shape.astype(np.uint64) * _BASE))


def longest_elsewhere(pieces: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the joined pieces (a divider after each), how far it is repeated; and where pieces begin."""
    bounds = np.cumsum([0, *(len(p) + 1 for p in pieces)])
    numbers = np.empty(bounds[-1], dtype=np.int64)
    for i, piece in enumerate(pieces):
        numbers[bounds[i] : bounds[i + 1] - 1] = piece
        numbers[bounds[i + 1] - 1] = -1 - i  # dividers are unlike anything
    return Suffixes(numbers).elsewhere(), bounds


def repeated_windows(pieces: list[list[int]], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(piece, first, end) of the words of ``pieces`` that repeated windows cover, by a greedy parse of each piece."""
    longest, bounds = longest_elsewhere(pieces)
    n = len(longest)
    inside = np.zeros(n + 1, dtype=np.int64)  # starts of windows within one factor, as steps
    across = np.zeros(n + 1, dtype=np.int64)  # starts of windows across a factor boundary, as steps
    start, end = bounds[:-1], bounds[1:] - 1
    at = start.copy()
    while len(at):
        factor = np.maximum(longest[at], 1)  # a word that stands nowhere else is a factor of its own
        long = factor >= window
        np.add.at(inside, at[long], 1)
        np.add.at(inside, (at + factor)[long] - window + 1, -1)
        at = at + factor
        open_ = at < end
        at, start, end = at[open_], start[open_], end[open_]
        first, last = np.maximum(start, at - window + 1), np.minimum(at - 1, end - window)
        there = first <= last
        np.add.at(across, first[there], 1)
        np.add.at(across, last[there] + 1, -1)
    starts = np.cumsum(inside[:-1]) > 0
    asked = np.flatnonzero(np.cumsum(across[:-1]) > 0)
    starts[asked[longest[asked] >= window]] = True
    begin = np.flatnonzero(starts)
    if not len(begin):
        return []
    new = np.r_[True, begin[1:] > begin[:-1] + window]
    lo, hi = begin[new], np.r_[begin[:-1][new[1:]], begin[-1]] + window
    owner = np.searchsorted(bounds, lo, side="right") - 1
    # Spans of neighbouring pieces are apart by a divider and never merge: a window ends before it.
    return list(zip(owner.tolist(), (lo - bounds[owner]).tolist(), (hi - bounds[owner]).tolist(), strict=True))


def _merge(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans united where they meet."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(lo[1:] > hi[:-1]) + 1
    return lo[np.r_[0, new]], hi[np.r_[new - 1, len(hi) - 1]]


_FOUND = "core long, seg long, k1 long, k2 long, place long"
_SPAN = "k1 long, k2 long, lo long, hi long"


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of each text, with a hash of the piece around each."""
    for batch in slices(batches):
        out: list[tuple[np.ndarray, ...]] = []
        seen: set[tuple[int, int]] = set()
        for a, b, text in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("text"), strict=True):
            if (a, b) in seen:
                continue
            seen.add((a, b))
            hashes = word_hashes(text.as_buffer().to_pybytes().split())
            place, value = anchors(hashes)
            if len(place):
                lo, hi = np.maximum(0, place - SLACK), np.minimum(len(hashes), place + WINDOW)
                seg = _range_hashes(hashes, lo, hi, (place - lo) * 1024 + hi - place)
                out.append((value.view(np.int64), seg.view(np.int64), np.full(len(place), a), np.full(len(place), b), place))
        if out:
            yield _batch([np.concatenate(c) for c in zip(*out, strict=True)], ["core", "seg", "k1", "k2", "place"])


_PIECE = "core long, n long, a int, b int, k1 long, k2 long, lo long, at int, words binary"
_PIECE_NAMES = ["core", "n", "a", "b", "k1", "k2", "lo", "at", "words"]
_PART = f"whole boolean, hi long, {_PIECE}"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text: united spans of pieces that stand twice, and the pieces to be parsed."""
    types = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.binary()]
    for batch in slices(batches, 64):
        out: list[tuple] = []
        marks = batch.column("marks")
        whole, core, n, place = (pc.struct_field(marks.flatten(), f).to_numpy(zero_copy_only=False) for f in ("whole", "core", "n", "place"))
        ends = np.cumsum([0, *pc.list_value_length(marks).to_pylist()])
        keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), batch.column("text"), strict=True)
        for i, (k1, k2, text) in enumerate(keys):
            words = text.as_buffer().to_pybytes().split()
            own = np.arange(ends[i], ends[i + 1])
            lo, hi = np.maximum(0, place - SLACK), np.minimum(len(words), place + WINDOW)
            twice = own[whole[own].astype(bool)]
            if len(twice):
                spans = zip(*(x.tolist() for x in _merge(lo[twice], hi[twice])), strict=True)
                out += [(True, h, None, None, None, None, k1, k2, x, None, None) for x, h in spans]
            for j in own[~whole[own].astype(bool)].tolist():
                x, h = int(lo[j]), int(hi[j])
                out.append((False, h, core[j], n[j], 0, GRAM, k1, k2, x, int(place[j]) - x, b" ".join(words[x:h])))
        if out:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield _batch(columns, ["whole", "hi", *_PIECE_NAMES])


def widened(a: int, b: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """The two longer anchors that take over from one with ``a`` words before the first and ``b`` from it on.

    A window has ``WINDOW - a - b`` more words. Either at least half of them, rounded up, lie to the right, or more
    than the other half to the left.
    """
    slack = WINDOW - a - b
    half = (slack + 1) // 2
    return (a, b + half), (a + slack - half + 1, b)


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece under its two longer anchors (where it holds them), cut to what windows with them reach."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.binary()]
    digest = xxhash.xxh3_64_intdigest
    for batch in slices(batches, 1000):
        out: list[tuple] = []
        for row in batch.to_pylist():
            words = row["words"].split(b" ")
            for a, b in widened(row["a"], row["b"]):
                first, end = row["at"] - a, row["at"] + b
                if first < 0 or end > len(words):
                    continue
                slack = WINDOW - a - b
                x, h = max(0, first - slack), min(len(words), end + slack)
                text = b" ".join(words[x:h])
                core = digest(b"%d " % a + b" ".join(words[first:end]))
                seg = digest(b"%d " % (first - x) + text)
                out.append((core, seg, a, b, row["k1"], row["k2"], row["lo"] + x, row["at"] - x, text))
        columns = list(zip(*out, strict=True)) or [()] * len(types)
        for i in (0, 1):
            columns[i] = np.asarray(columns[i], dtype=np.uint64).view(np.int64)
        yield _batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["core", "seg", *_PIECE_NAMES[2:]])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated spans within blocks of whole anchors; pieces of one text that overlap become one."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[1:4])
        owners: list[tuple[int, int, int]] = []
        pieces: list[list[int]] = []
        numbers: dict[bytes, int] = {}
        reached = 0
        for _, k1, k2, lo, text in rows:
            words = text.split(b" ")
            if not owners or owners[-1][:2] != (k1, k2) or lo > reached:
                owners.append((k1, k2, lo))
                pieces.append([])
                reached = lo
            fresh = words[reached - lo :]
            pieces[-1] += [numbers.setdefault(w, len(numbers)) for w in fresh]
            reached += len(fresh)
        found = [(*owners[i][:2], owners[i][2] + lo, owners[i][2] + hi) for i, lo, hi in repeated_windows(pieces)]
        columns = list(zip(*found, strict=True)) or [()] * 4
        return _batch([pa.array(c, pa.int64()) for c in columns], ["k1", "k2", "lo", "hi"])

    held: list[tuple] = []
    for batch in slices(batches, 1000):
        for row in zip(*(batch.column(c).to_pylist() for c in ("core", "k1", "k2", "lo", "words")), strict=True):
            if len(held) >= BLOCK_PIECES and held[-1][0] != row[0]:
                yield settle(held)
                held = []
            held.append(row)
    if held:
        yield settle(held)


def _marks(rows: DataFrame) -> DataFrame:
    """k1, k2, marks: of each text, the places of pieces that stand twice, and one place of each piece to be parsed."""
    found = stored(rows.mapInArrow(_anchor_rows, _FOUND))
    per_core = found.groupBy("core").agg(F.count(F.lit(1)).alias("total"), (F.min("seg") != F.max("seg")).alias("differ"))
    shared = stored(per_core.where("total > 1"))
    hits = stored(found.join(shared, "core"))
    forget(found)
    forget(shared)
    first = F.min(F.struct("k1", "k2", "place")).alias("first")
    per_seg = hits.groupBy("core", "seg").agg(F.count(F.lit(1)).alias("same"), first, F.first("differ").alias("differ"))
    groups = stored(per_seg.where("same > 1 or differ"))
    members = hits.join(groups.where("same > 1").select("core", "seg"), ["core", "seg"])
    nothing = F.lit(0).cast("long")
    mark = F.struct(F.lit(True).alias("whole"), nothing.alias("core"), nothing.alias("n"), "place").alias("mark")
    whole = members.select("k1", "k2", mark)
    differing = groups.where("differ").select("core", "first.*")
    counts = stored(differing.groupBy("core").agg(F.count(F.lit(1)).alias("n")))
    rims = differing.join(counts, "core")
    mark = F.struct(F.lit(False).alias("whole"), "core", "n", "place").alias("mark")
    both = whole.union(rims.select("k1", "k2", mark))
    return both.groupBy("k1", "k2").agg(F.collect_list("mark").alias("marks"))  # as many as the text has anchors


def _widen(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of pieces that stand twice under longer anchors, and the different pieces of these anchors."""
    rows = stored(pieces.mapInArrow(_children, f"core long, seg long, {_PIECE.split(', ', 2)[2]}"))
    carried = [c for c in _PIECE_NAMES if c not in ("core", "n")]
    first = F.min(F.struct("k1", "k2", "lo", "at", "words", "a", "b")).alias("first")
    groups = stored(rows.groupBy("core", "seg").agg(F.count(F.lit(1)).alias("same"), first))
    lengths = groups.where("same > 1").select("core", "seg", F.expr("size(split(cast(first.words as string), ' '))").alias("n_words"))
    members = rows.select("core", "seg", "k1", "k2", "lo").join(lengths, ["core", "seg"])
    spans = stored(members.select("k1", "k2", "lo", (F.col("lo") + F.col("n_words")).alias("hi")))
    different = groups.select("core", "first.*")
    counts = stored(different.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    kept = stored(different.join(counts, "core").select("core", "n", *sorted(carried, key=_PIECE_NAMES.index)))
    for done in (rows, groups, counts):
        forget(done)
    return spans, kept


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each different text."""
    for batch in slices(batches):
        out = []
        columns = (batch.column(c) for c in ("k1", "k2", "copies", "spans", "text"))
        for k1, k2, copies, spans, text in zip(*columns, strict=True):
            words = text.as_buffer().to_pybytes().split()
            bounds: list[int] = []
            if copies.as_py() > 1 and len(words) >= WINDOW:
                bounds = [0, len(words)]
            elif spans.is_valid:
                parts = spans.values
                lo, hi = _merge(*(pc.struct_field(parts, f).to_numpy(zero_copy_only=False) for f in ("lo", "hi")))
                bounds = np.stack([lo, hi], axis=1).ravel().tolist()
            ends = [0, *bounds, None]
            kept = [w for a, b in zip(ends[::2], ends[1::2], strict=True) for w in words[a:b]]
            out.append((k1.as_py(), k2.as_py(), len(words), len(words) - len(kept), bounds, hashlib.sha256(b" ".join(kept)).hexdigest()))
        types = [*[pa.int64()] * 4, pa.list_(pa.int64()), pa.string()]
        columns = list(zip(*out, strict=True)) or [()] * 6
        yield _batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["k1", "k2", "n_words", "n_removed", "bounds", "kept_sha256"])


def duplicate_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, bounds (first words and ends of what goes, flat), kept_sha256 of every row."""
    n = shuffle_partitions(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(1), body).alias("k2"), body.alias("text")
    )
    texts = rows.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    marked = texts.join(_marks(rows.select("k1", "k2", "text")), ["k1", "k2"]).select("k1", "k2", "text", "marks")
    parts = stored(marked.mapInArrow(_parts, _PART))
    spans = parts.where("whole").select("k1", "k2", "lo", "hi")
    pieces = parts.where("not whole").select(*_PIECE_NAMES)
    while True:
        few = pieces.where(F.col("n") <= BLOCK_PIECES).select("core", "k1", "k2", "lo", "words")
        dealt = few.repartition(n, "core").sortWithinPartitions("core")
        spans = spans.union(dealt.mapInArrow(_parse, _SPAN))
        many = pieces.where(F.col("n") > BLOCK_PIECES)
        if many.isEmpty():
            break
        more, pieces = _widen(many)
        spans = spans.union(more)
    gone = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    left = texts.join(gone, ["k1", "k2"], "left").mapInArrow(
        _cut, "k1 long, k2 long, n_words long, n_removed long, bounds array<long>, kept_sha256 string"
    )
    return rows.select("doc_id", "k1", "k2").join(left, ["k1", "k2"]).drop("k1", "k2")
