"""Toxicity by nearest labelled examples under exact TF-IDF cosine, found through a block-max inverted index.

Every word of the examples spans the space; document frequencies are counted over all documents. Words that a bounded
sample of labelled rows shows to go with the label (chi-square, over groups of like texts so that copies do not speak
twice) weigh ``1 + STRESS`` times as much, so that one such word is not drowned in a long text. Examples with the same
vector are one entry with a count. Entries stand in blocks; for every term and block the index keeps the largest weight,
so a query scores the blocks of the highest bounds first and then only those whose bound reaches its k-th best. Terms of
more than a tenth of the entries are multiplied out for several queries at once instead, and count in the bounds as they
are. Near examples vote by distance, and an isotonic curve fitted on leave-one-out votes turns votes into scores.

The sample for word statistics is bounded by ``SAMPLE_ROWS``, the examples by ``PER_LABEL`` of either label (the curve
weighs them back to the sample's shares); frequencies and scores cover every text whole. Defined results: null and empty
texts, and texts without a word of any example, have no neighbours and get the share of toxic rows among such examples;
repeated rows get the same score each; rows with a null label or id teach nothing; without labels every score is 0; an
empty table gives an empty result; further columns are ignored; ids may be of any type.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import forget, is_held_out, slices, stored
from lakeworks.llm.quality import training_sample

SAMPLE_ROWS, PER_LABEL = 20_000, 4_000
THRESHOLD = 0.3
MIN_GROUPS, MIN_CHI2, STRESS = 8, 30.0, 15.0
NEIGHBOURS, BLOCK, FIRST_BLOCKS, NEAR = 15, 64, 4, 0.05
REMEMBERED = 50_000
POSTINGS = 200_000  # of the queries scored together
COMMON, SLACK, DIGITS = 0.1, 1e-9, 12
WORD = re.compile(r"\w+")
BETWEEN = re.compile(r"[^\w\x00-\x7f]")
BLANKED = bytes(i if i > 127 or WORD.match(chr(i)) else 32 for i in range(256))


def words(text: str | None) -> list[str]:
    """What ``WORD`` finds in the lower-cased text, by blanking all other characters, which is faster."""
    lowered = (text or "").lower()
    if not lowered.isascii():
        lowered = BETWEEN.sub(" ", lowered)
    return lowered.encode().translate(BLANKED).decode().split()


def _likeness(found: list[str]) -> int:
    """One number that near copies mostly share: the smallest hash of neighbouring word pairs."""
    pairs = (zlib.crc32(f"{a} {b}".encode()) for a, b in zip(found, found[1:]))
    return min(pairs, default=0)


def telling_terms(taught: DataFrame) -> list[str]:
    """Terms that go with the label. ``taught``: _text, _label of the bounded sample."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            terms, groups, marks = [], [], []
            for text, label in zip(batch.column("_text").to_pylist(), batch.column("_label").to_pylist(), strict=True):
                found = words(text)
                own = set(found)
                terms += own
                groups += [_likeness(found)] * len(own)
                marks += [label] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array(groups, pa.int64()), pa.array(marks, pa.int32())],
                names=["term", "likeness", "label"],
            )

    rows = taught.mapInArrow(spread, "term string, likeness long, label int")
    per_term = rows.groupBy("term", "likeness").agg(F.max("label").alias("label")).groupBy("term")
    counts = per_term.agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n")).where(f"n >= {MIN_GROUPS}")
    sizes = taught.agg(F.sum("_label").alias("bad"), F.count(F.lit(1)).alias("n")).first()
    all_n, all_bad = sizes["n"], sizes["bad"] or 0
    if not all_bad or all_bad == all_n:
        return []
    bad, n = F.col("bad").cast("double"), F.col("n").cast("double")
    # the two-by-two chi-square, from how far the term's toxic count is from its expectation
    spread_of = n * F.lit(float(all_bad)) / all_n * (1 - F.lit(float(all_bad)) / all_n)
    chi2 = F.pow(bad - n * all_bad / all_n, 2) / (spread_of * (1 - n / all_n + 1e-9))
    above = counts.where(bad / n > 2 * F.lit(float(all_bad)) / all_n).withColumn("chi2", chi2)
    strong = above.where(F.col("chi2") >= MIN_CHI2)  # at most the words of the sample
    return sorted(r["term"] for r in strong.select("term").collect())


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


@dataclass
class Examples:
    """Block-max inverted index over the distinct example vectors.

    Terms of more than ``COMMON`` of the entries stand in ``tile`` (terms x entries, row ``tile_row`` of the term), not in
    postings: each would be in almost every block, so that its block maxima could not close any.
    ``cells`` are the (term, block) pairs that hold postings, by term: cell ``c`` of block ``cell_block[c]`` has the
    postings ``cell_start[c]`` up to ``cell_start[c + 1]`` and the largest weight ``cell_max[c]``.
    """

    terms: dict[str, int]
    idf: np.ndarray
    telling: frozenset[int]
    count: np.ndarray  # rows with this vector
    bad: np.ndarray  # of them toxic
    ids: list[list]  # a few of them, as evidence
    term_start: np.ndarray  # first cell of each term
    cell_block: np.ndarray
    cell_max: np.ndarray
    cell_start: np.ndarray
    entry: np.ndarray  # of each posting
    weight: np.ndarray
    tile: np.ndarray
    tile_row: np.ndarray
    curve: tuple[np.ndarray, np.ndarray]
    blank: float

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the text's known terms, ascending, and their times in it."""
        counts = Counter(words(text))
        at = np.fromiter(map(self.terms.get, counts, repeat(-1)), dtype=np.int64, count=len(counts))
        times = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
        order = np.argsort(at)[np.count_nonzero(at < 0) :]
        return at[order], times[order]

    def weights(self, vector: tuple[tuple[int, int], ...]) -> np.ndarray:
        return _weights(vector, self.idf)

    def nearest(self, vector: tuple[tuple[int, int], ...], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the k nearest, nearest first (ties: earlier entry)."""
        pairs = np.asarray(vector, dtype=np.int64).reshape(-1, 2)
        return next(self.nearest_of([(pairs[:, 0], pairs[:, 1])], k))

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` for vectors as term and times arrays, together as long as their postings stay few."""
        postings = self.cell_start[self.term_start]  # first posting of each term
        some: list[tuple[np.ndarray, np.ndarray]] = []
        room = POSTINGS
        for at, times in queries:
            need = int((postings[at + 1] - postings[at]).sum())
            if some and need > room:
                yield from self._together(some, k)
                some, room = [], POSTINGS
            some.append((at, times))
            room -= need + len(self.count)
        if some:
            yield from self._together(some, k)

    def _together(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        n, n_blocks, many = len(self.count), -(-len(self.count) // BLOCK), len(queries)
        at, times = (np.concatenate([v[i] for v in queries]) for i in (0, 1))
        query = np.repeat(np.arange(many), [len(v[0]) for v in queries])
        weight = (1 + np.log(times)) * self.idf[at]
        weight /= np.sqrt(np.bincount(query, weight * weight, many))[query]
        # Common terms are multiplied out for all entries; they bound their blocks by what they give at most.
        common = np.zeros((many, len(self.tile)))
        in_tile = self.tile_row[at] >= 0
        common[query[in_tile], self.tile_row[at[in_tile]]] = weight[in_tile]
        score = np.zeros((many, n_blocks * BLOCK))
        score[:, :n] = common @ self.tile
        blocks = score.reshape(many, n_blocks, BLOCK)
        held = self.term_start[at + 1] - self.term_start[at]
        cells, term = _ranges(self.term_start[at], held), np.repeat(np.arange(len(at)), held)
        place = query[term] * n_blocks + self.cell_block[cells]
        bound = np.bincount(place, weight[term] * self.cell_max[cells], many * n_blocks) + blocks.max(axis=2, initial=0).ravel()
        # The blocks of the highest bounds first, then those whose bound reaches the k-th best of these.
        opened = np.zeros((many, n_blocks), dtype=bool)
        by_bound = np.argsort(-bound.reshape(many, n_blocks), axis=1, kind="stable")[:, :FIRST_BLOCKS]
        np.put_along_axis(opened, by_bound, True, axis=1)
        score[:, :n] += self._scores(cells, term, weight, query, opened.ravel()[place], many)
        kth = np.zeros(many)
        if min(FIRST_BLOCKS, n_blocks) * BLOCK > k:
            tried = blocks[np.arange(many)[:, None], by_bound].reshape(many, -1)
            kth = np.partition(tried, -k, axis=1)[:, -k]
        more = (bound > 0) & ~opened.ravel() & (bound >= np.repeat(kth, n_blocks) - SLACK)
        if more.any():
            score[:, :n] += self._scores(cells, term, weight, query, more[place], many)
        blocks[~(opened | more.reshape(many, n_blocks))] = 0
        # Rounded, so that the same text is judged alike whatever stands beside it.
        for own, least in zip(score, kth.tolist(), strict=True):
            near = np.flatnonzero(own >= max(least - SLACK, SLACK))
            cosine = np.round(own[near], DIGITS)
            first = np.lexsort((near, -cosine))[:k]
            yield near[first], cosine[first]

    def _scores(self, cells: np.ndarray, term: np.ndarray, weight: np.ndarray, query: np.ndarray, chosen: np.ndarray, many: int) -> np.ndarray:
        """Exact cosines (queries x entries) over the chosen cells, 0 elsewhere.

        ``term`` numbers the query term of each cell, ``weight`` and ``query`` are those of the query terms. Neighbouring cells
        of one query term are read as one run of postings.
        """
        cells, term = cells[chosen], term[chosen]
        ends = np.ones(len(cells) + 1, dtype=bool)
        ends[1:-1] = (term[1:] != term[:-1]) | (cells[1:] != cells[:-1] + 1)
        first, last = np.flatnonzero(ends[:-1]), np.flatnonzero(ends[1:])
        starts, term = self.cell_start[cells[first]], term[first]
        sizes = self.cell_start[cells[last] + 1] - starts
        places = _ranges(starts, sizes)
        slot = np.repeat(query[term] * len(self.count), sizes) + self.entry[places]
        value = np.repeat(weight[term], sizes) * self.weight[places]
        return np.bincount(slot, value, many * len(self.count)).reshape(many, -1)

    def vote(self, near: np.ndarray, cosine: np.ndarray, own: int = -1, label: int = 0) -> float:
        """Distance-weighted share of toxic rows; ``own`` is an entry that loses one row of this label."""
        count = self.count[near] - (near == own)
        weight = count / (NEAR + 1 - np.minimum(cosine, 1))
        bad = self.bad[near] - (near == own) * label
        total = float(weight.sum())
        return float((weight * bad / np.maximum(count, 1)).sum()) / total if total else self.blank


def _weights(vector: tuple[tuple[int, int], ...], idf: np.ndarray) -> np.ndarray:
    pairs = np.asarray(vector, dtype=np.int64)
    weight = (1 + np.log(pairs[:, 1])) * idf[pairs[:, 0]]
    return weight / math.sqrt(float(weight @ weight))


def _isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: a rising curve through (vote, label) of ``n`` rows each."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of x, sum of y, n
    for a, b, c in zip(x[order].tolist(), y[order].tolist(), n[order].tolist(), strict=True):
        pools.append([a * c, b * c, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            top = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], top, strict=True)]
    xs = np.asarray([p[0] / p[2] for p in pools])
    return xs, np.asarray([(p[1] + 0.1) / (p[2] + 0.2) if p[2] < 5 else p[1] / p[2] for p in pools])


def build(rows: list[tuple], terms: list[str], idf: np.ndarray, telling: frozenset[int] = frozenset(), shares: tuple[float, float] = (1.0, 1.0)) -> Examples:
    """Index the bounded examples (id, label, vector); each stands for ``shares[label]`` rows of the sample."""
    grouped: dict[tuple, list[tuple]] = {}
    for name, label, vector in rows:
        grouped.setdefault(vector, []).append((name, label))
    blanks = [label for _, label in grouped.pop((), [])]
    blank = (sum(blanks) * shares[1] + 0.5) / (sum(shares[y] for y in blanks) + 1) if rows else 0.0
    vectors = sorted(grouped)
    sizes = np.asarray([len(v) for v in vectors], dtype=np.int64)
    entry = np.repeat(np.arange(len(vectors)), sizes)
    term = np.asarray([t for v in vectors for t, _ in v], dtype=np.int64)
    weight = np.concatenate([_weights(v, idf) for v in vectors]) if vectors else np.zeros(0)
    common = np.bincount(term, minlength=len(terms)) > COMMON * max(1, len(vectors))
    tile_row = np.where(common, np.cumsum(common) - 1, -1)
    tile = np.zeros((int(common.sum()), len(vectors)))
    in_tile = common[term]
    tile[tile_row[term[in_tile]], entry[in_tile]] = weight[in_tile]
    term, entry, weight = term[~in_tile], entry[~in_tile], weight[~in_tile]
    order = np.lexsort((entry, term))
    term, entry, weight = term[order], entry[order], weight[order]
    block = entry // BLOCK
    first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(term) else np.zeros(0, dtype=np.int64)
    index = Examples(
        {t: i for i, t in enumerate(terms)}, idf, telling,
        np.asarray([len(grouped[v]) for v in vectors], dtype=np.float64),
        np.asarray([sum(y for _, y in grouped[v]) for v in vectors], dtype=np.float64),
        [sorted(name for name, _ in grouped[v])[:3] for v in vectors],
        np.searchsorted(term[first], np.arange(len(terms) + 1)), block[first],
        np.maximum.reduceat(weight, first) if len(first) else np.zeros(0), np.r_[first, len(term)],
        entry, weight, tile, tile_row, (np.zeros(0), np.zeros(0)), blank,
    )
    votes, marks, stands_for = [], [], []
    queries = [tuple(np.asarray(v, dtype=np.int64).T) for v in vectors]
    for place, (near, cosine) in enumerate(index.nearest_of(queries, NEIGHBOURS)):
        for label in (0, 1):
            times = index.bad[place] if label else index.count[place] - index.bad[place]
            if times:
                votes.append(index.vote(near, cosine, place, label))
                marks.append(label)
                stands_for.append(times * shares[label])
    if votes:
        index.curve = _isotonic(np.asarray(votes), np.asarray(marks, dtype=np.float64), np.asarray(stands_for))
    return index


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[str] = set()
    for batch in slices(batches):
        for text in batch.column("_text").to_pylist():
            seen.update(words(text))
    yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], names=["term"])


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> Examples:
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    sample = F.broadcast(training_sample(labels, "toxic", rows))  # bounded by ``rows``
    taught = stored(texts.join(sample, "_key"))
    # The sample's rows in the order of a hash; what is taken of either label is bounded, too.
    by_hash = [F.xxhash64("_key"), F.col("_key"), F.xxhash64("_text")]
    some = [taught.where(F.col("_label") == y).orderBy(*by_hash).limit(PER_LABEL) for y in (0, 1)]
    examples = stored(some[0].unionByName(some[1]))
    in_sample = {r["_label"]: r["n"] for r in taught.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = tuple(max(1.0, in_sample.get(y, 0) / PER_LABEL) for y in (0, 1))
    terms = sorted(examples.mapInArrow(_vocabulary, "term string").distinct().toArrow().column("term").to_pylist())
    place = {t: i for i, t in enumerate(terms)}
    telling = frozenset(place[t] for t in telling_terms(taught) if t in place)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(len(terms) + 1, dtype=np.int64), 0
        for batch in slices(batches):
            for body in batch.column(0).to_pylist():
                own = set(words(body))  # unknown words fall into the last place
                seen[np.fromiter(map(place.get, own, repeat(-1)), dtype=np.int64, count=len(own))] += 1
                n += 1
        seen[-1] = n
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen[held])], names=["term", "n"])

    counted = texts.select("_text").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = counted.toArrow()  # one row per word of the examples
    held = np.zeros(len(terms) + 1)
    held[df.column("term").to_numpy()] = df.column("n").to_numpy()
    idf = np.log((1 + held[-1]) / (1 + held[:-1])) + 1
    idf[list(telling)] *= 1 + STRESS

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [sorted((place[w], n) for w, n in Counter(words(t)).items()) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"), batch.column("_label"),
                    pa.array([[t for t, _ in v] for v in found], pa.list_(pa.int32())), pa.array([[n for _, n in v] for v in found], pa.list_(pa.int32())),
                ],
                names=["_key", "_label", "t", "n"],
            )

    kind = taught.schema["_key"].dataType.simpleString()
    learned = examples.mapInArrow(vectors, f"_key {kind}, _label int, t array<int>, n array<int>").toArrow()
    known = sorted(
        (
            (name, label, tuple(zip(t, n, strict=True)))
            for name, label, t, n in zip(*[learned.column(c).to_pylist() for c in ("_key", "_label", "t", "n")], strict=True)
        ),
        key=lambda row: row[:2],
    )
    forget(examples)
    forget(taught)
    return build(known, terms, idf, telling, shares)


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours (ids of near examples), terms (the telling ones in the text)."""
    index = fit(docs, labels, key, text)
    names = list(index.terms)

    telling = np.zeros(len(names) + 1, dtype=bool)
    telling[list(index.telling)] = True

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: OrderedDict[bytes, tuple[float, list, list[str]]] = OrderedDict()
        for batch in slices(batches):
            texts = batch.column("_text").to_pylist()
            digests = [hashlib.blake2b((t or "").encode(), digest_size=16).digest() for t in texts]
            judged = {d: memory[d] for d in digests if d in memory}
            new = {d: t for d, t in zip(digests, texts, strict=True) if d not in judged}
            vectors = [index.vector(t) for t in new.values()]
            for digest, vector, near in zip(new, vectors, index.nearest_of(vectors, NEIGHBOURS), strict=True):
                judged[digest] = (*_judge(index, *near), [names[t] for t in vector[0][telling[vector[0]]].tolist()])
                memory[digest] = judged[digest]
            while len(memory) > REMEMBERED:
                memory.popitem(last=False)
            values, ids, found = zip(*[judged[d] for d in digests], strict=True) if texts else ((), (), ())
            own = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [own, pa.array(values, pa.float64()), pa.array(ids, pa.list_(own.type)), pa.array(found, pa.list_(pa.string()))],
                names=["doc_id", "score", "neighbours", "terms"],
            )

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    judged = rows.mapInArrow(score, f"doc_id {kind}, score double, neighbours array<{kind}>, terms array<string>")
    return judged.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "neighbours", "terms",
    )


def _judge(index: Examples, near: np.ndarray, cosine: np.ndarray) -> tuple[float, list]:
    if not len(near):
        return index.blank, []
    value = float(np.interp(index.vote(near, cosine), *index.curve))
    return value, [i for e in near[:3].tolist() for i in index.ids[e]][:5]
