"""Line dedup by pairwise alignment: common blocks go from the later of two overlapping documents.

A document overlaps with the earliest holder (by id) of each of its telling lines. These are lines of at least
``MIN_WORDS`` words (or ``MIN_UNSPACED`` characters of scripts without blanks), runs of ``RUN`` shorter lines together
(blank lines between them do not count), and shorter lines that few documents hold. Pairing with the earliest holder only keeps pairs linear in the lines however
frequent a line is. Each pair of line-hash lists is aligned by patience diff: lines that are unique in both anchor the
alignment in their longest rising order, common lines next to anchors join, and gaps are aligned the same way. Aligned
blocks that hold a telling line are deleted from the later document, all judged on the input texts. Blocks that cross
the alignment and repeated lines go as well, paired by occurrences. A line that is unique in both and has moved alone
stays, and its document is aligned with the earliest of the other documents that keep the line, until no two keep one
that they were not aligned for.

Defined results: a null text has no lines and stays null; empty texts stay; rows that repeat an id and a text are one
document and get the same result; ids are whole numbers, a null id comes after all others; an empty table gives an empty
result; texts are read whole; further columns stay as they are, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import forget, slices, stored

MIN_WORDS = 5
RUN, RUN_CHARS = 3, 20  # short lines that pair documents together, and their least characters
SHORT_CHARS, RARE, RARE_SHARE = 12, 10, 0.001  # a shorter line is telling if it has these characters and so few documents hold it
#: Characters of scripts without blanks between words, and how many are a telling line.
UNSPACED, MIN_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"), 10
LAST = (1 << 63) - 1


def _anchors(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of lines unique in both, in the longest order that rises in both."""
    in_a, in_b = Counter(a), Counter(b)
    at_b = {x: j for j, x in enumerate(b) if in_b[x] == 1}
    pairs = [(i, at_b[x]) for i, x in enumerate(a) if in_a[x] == 1 and x in at_b]
    tops: list[int] = []
    heads: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(heads[pile - 1] if pile else -1)
        tops[pile : pile + 1] = [j]
        heads[pile : pile + 1] = [k]
    chain, k = [], heads[-1] if heads else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places of equal lines, rising in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        chain = _anchors(a[a0:a1], b[b0:b1])
        if chain:
            ends = [(a0 + i, b0 + j) for i, j in chain]
            out += ends
            starts = [(a0, b0), *[(i + 1, j + 1) for i, j in ends]]
            for (i0, j0), (i1, j1) in zip(starts, [*ends, (a1, b1)], strict=True):
                todo.append((i0, i1, j0, j1))
    return sorted(out)


def _blocks(aligned: list[tuple[int, int]], telling: set[int]) -> list[int]:
    """Places in the first list of blocks (neighbours in both) with at least one telling place."""
    gone: list[int] = []
    block: list[tuple[int, int]] = []
    for i, j in [*aligned, (-1, -1)]:
        if block and (i, j) != (block[-1][0] + 1, block[-1][1] + 1):
            if any(x in telling for x, _ in block):
                gone += [x for x, _ in block]
            block = []
        block.append((i, j))
    return gone


def _paired(a: list[int], b: list[int], telling: set[int], gone: set[int]) -> set[int]:
    """``gone`` and the blocks around telling places left, each paired with its line's next occurrence in ``b``.

    A line that is unique in both and has moved alone, without a neighbour, stays.
    """
    places: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        places.setdefault(x, []).append(j)
    times = Counter(a)
    out, last = set(gone), -1
    for i in sorted(telling - gone):
        if i in out:
            continue
        own = places[a[i]]
        after = bisect_left(own, last + 1)
        j = own[after if after < len(own) else 0]
        first, stop = i, i + 1
        while first and first - 1 not in out and j >= i - first + 1 and a[first - 1] == b[j - (i - first) - 1]:
            first -= 1
        while stop < len(a) and stop not in out and j + stop - i < len(b) and a[stop] == b[j + stop - i]:
            stop += 1
        if stop - first > 1 or len(own) > 1 or times[a[i]] > 1:
            out.update(range(first, stop))
            last = j + stop - i - 1
    return out


def common_blocks(a: list[int], b: list[int], telling: set[int]) -> list[int]:
    """Places in ``a`` of blocks common with ``b`` that hold ``telling`` places, whose lines ``b`` must hold.

    Blocks that cross the alignment, and repeated lines it does not reach, are paired occurrence by occurrence.
    """
    gone = set(_blocks(patience(a, b), telling))
    return sorted(gone if telling <= gone else _paired(a, b, telling, gone))


def runs(lines: list[int]) -> dict[int, list[tuple[int, ...]]]:
    """Hash of every run of ``RUN`` lines that are not empty, and the places it stands at."""
    full, out = [i for i, x in enumerate(lines) if x], {}
    for at in range(len(full) - RUN + 1):
        places = tuple(full[at : at + RUN])
        key = xxhash.xxh64_intdigest(b"".join((lines[i] & LAST).to_bytes(8, "little") for i in places), 1)
        out.setdefault(key - (1 << 63), []).append(places)
    return out


def telling_places(a: list[int], b: list[int], own: set[int]) -> set[int]:
    """Places of ``a`` with a line, or in a run of lines, that is among ``own`` and that ``b`` holds as well."""
    common = own.intersection(b)
    telling = {i for i, x in enumerate(a) if x in common}
    in_a = {k: v for k, v in runs(a).items() if k in own}
    for key in in_a.keys() & runs(b).keys() if in_a else ():
        telling.update(i for places in in_a[key] for i in places)
    return telling


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lines (hashes, 0 for an empty line), telling (of long lines and runs of short ones), short (may be telling if rare)."""
    for batch in slices(batches):
        all_lines, telling, short = [], [], []
        for text in batch.column("text").to_pylist():
            parts = [x.strip(" ") for x in text.split("\n")]
            lines = [xxhash.xxh64_intdigest(x.encode("utf-8", "replace"), 42) - (1 << 63) if x else 0 for x in parts]
            weight = [len(x) - x.count(" ") for x in parts]
            long = [len(x.split()) >= MIN_WORDS or len(UNSPACED.findall(x)) >= MIN_UNSPACED for x in parts]
            own = {h for h, is_long in zip(lines, long, strict=True) if is_long}
            if len(parts) - sum(long) >= RUN:
                for key, stands in runs(lines).items():
                    at = stands[0]
                    if not any(long[i] for i in at) and sum(weight[i] for i in at) >= RUN_CHARS and len({lines[i] for i in at}) > 1:
                        own.add(key)
            all_lines.append(lines)
            telling.append(sorted(own))
            short.append(sorted({h for h, w in zip(lines, weight, strict=True) if w >= SHORT_CHARS} - own))
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (all_lines, telling, short)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), *lists], names=["id", "mark", "lines", "telling", "short"])


def _identity(key: str, text: str) -> tuple[Column, Column]:
    return F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"), F.xxhash64(text).alias("mark")


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, mark (hash of the text), gone: places of the lines to delete; only documents that lose some."""
    slim = docs.where(F.col(text).isNotNull()).select(*_identity(key, text), F.col(text).alias("text"))
    kinds = "id long, mark long, lines array<long>, telling array<long>, short array<long>"
    lists = stored(slim.mapInArrow(_read, kinds).dropDuplicates(["id", "mark"]))
    long = lists.select("id", "mark", F.explode("telling").alias("line"), F.lit(False).alias("is_short"))
    short = lists.select("id", "mark", F.explode("short").alias("line"), F.lit(True).alias("is_short"))
    own, rare, aligned = long.union(short), max(RARE, int(RARE_SHARE * lists.count())), None
    while True:
        found = _aligned(lists, own, rare)
        aligned = found if aligned is None else aligned.union(found)
        long = found.select("id", "mark", F.explode("left").alias("line"), F.lit(False).alias("is_short"))
        short = found.select("id", "mark", F.explode("left_rare").alias("line"), F.lit(True).alias("is_short"))
        own, rare = long.union(short).distinct(), LAST  # found rare above
        if own.isEmpty():
            break
        # The first document of a round is in no later one, so the rounds end.
        still = stored(lists.join(own.select("id", "mark").distinct(), ["id", "mark"], "left_semi"))
        forget(lists)
        lists = still
    forget(lists)
    merged = F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone"))))
    return aligned.where(F.size("gone") > 0).groupBy("id", "mark").agg(merged.alias("gone"))


def _aligned(lists: DataFrame, own: DataFrame, rare: int) -> DataFrame:
    """id, mark, gone, left and left_rare (telling lines that stay) for each document and earliest holder of lines in ``own``."""
    first = own.groupBy("line").agg(
        F.min(F.struct("id", "mark")).alias("first"), F.count(F.lit(1)).alias("n"), F.min("is_short").alias("is_short")
    )
    shared = first.where((F.col("n") > 1) & (~F.col("is_short") | (F.col("n") <= rare))).select("line", F.col("first.id").alias("e_id"), F.col("first.mark").alias("e_mark"))
    shared = stored(shared)  # so that the join deals both sides itself and can split a hot line
    later = (F.col("id") > F.col("e_id")) | ((F.col("id") == F.col("e_id")) & (F.col("mark") > F.col("e_mark")))
    brief = F.collect_set(F.when(F.col("is_short"), F.col("line"))).alias("rare")
    pairs = own.join(shared, "line").where(later).groupBy("id", "mark", "e_id", "e_mark").agg(brief)
    earlier = lists.select(F.col("id").alias("e_id"), F.col("mark").alias("e_mark"), F.col("lines").alias("e_lines"))
    both = pairs.join(lists.drop("short"), ["id", "mark"]).join(earlier, ["e_id", "e_mark"])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lines", "e_lines", "telling", "rare"))
            gone, left, left_rare = [], [], []
            for a, b, own, rare_ones in zip(*columns, strict=True):
                telling = telling_places(a, b, {*own, *rare_ones})
                gone.append(common_blocks(a, b, telling))
                stay = {a[i] for i in telling.difference(gone[-1])}
                left.append(sorted(stay.difference(rare_ones)))
                left_rare.append(sorted(stay.intersection(rare_ones)))
            lists = [pa.array(gone, pa.list_(pa.int32())), *[pa.array(x, pa.list_(pa.int64())) for x in (left, left_rare)]]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), *lists], names=["id", "mark", "gone", "left", "left_rare"])

    asked = both.select("id", "mark", "lines", "e_lines", "telling", "rare")
    return stored(asked.mapInArrow(align, "id long, mark long, gone array<int>, left array<long>, left_rare array<long>"))


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", n_lines: str = "n_lines", n_removed: str = "n_removed"
) -> DataFrame:
    """The documents with all their columns, ``text`` without the deleted lines, and two counts under the given names.

    A column of ``docs`` called like one of the counts is replaced by it.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"), *_identity(key, text), F.col(text).alias("text"))
    rows = rows.join(removed_lines(docs, key, text), ["id", "mark"], "left")
    lines = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    counts = {
        n_lines: F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long"),
        n_removed: F.coalesce(F.size("gone"), F.lit(0)).cast("long"),
    }
    own = [c for c in docs.columns if c.lower() not in {n.lower() for n in counts}]
    after = {text: F.when(F.col("gone").isNull(), F.col("text")).otherwise(left)}
    columns = [after.get(c, F.col("doc").getField(c)).alias(c) for c in own]
    return rows.select(*columns, *[value.alias(name) for name, value in counts.items()])
