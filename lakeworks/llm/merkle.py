"""Merkle manifest of a table, and proofs of its rows by octopus multiproofs.

Every row is a leaf: the SHA-256 of its fields, each written as its length in bytes, a colon and the value (``-`` for
null). The leaves of a source, ordered by id, form a tree of fan-out 16; the tops of these trees, ordered by source,
form one more tree, whose top is the root. Digests enter their parent as hexadecimal text.

Leaves are kept in blocks of ``16 ** BLOCK_LEVELS``. A block asks for the smallest set of nodes that the proofs of its
leaves need and that do not follow from the leaves themselves, gets each of them once, derives the shared inner
nodes, and expands the proof of every leaf on the spot. Positions come from one range shuffle by (source, id) and the
row counts of its partitions, so that no task sorts a whole source; a level of the tree is one aggregate of groups of
16. Only the root and the number of sources reach the driver.

Defined results: null fields are leaves' ``-``; a null id comes first in its source and is never tampered with; a null
source comes first; repeated rows are leaves of their own, in any order (they are equal); an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.llm.common import forget, stored
from lakeworks.session import shuffle_partitions

FAN = 16
BLOCK_LEVELS = 3
BLOCK = FAN**BLOCK_LEVELS
HEX = 64
#: The tree over the tops of the sources' trees.
TOP = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` or its byte count, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def positions(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` stored, with each row's place in its group as ``name`` and the group's rows as ``{name}_size``.

    One shuffle deals rows by ranges of (group, order), so a large group is spread over many tasks; a row's place is
    its place within its task plus the rows of the tasks before.
    """
    n = shuffle_partitions(rows.sparkSession)
    numbered = rows.withColumn("_row", F.monotonically_increasing_id())  # spreads rows that are equal throughout
    keys = [group, *order, "_row"]
    dealt = numbered.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_row")
    place = F.monotonically_increasing_id()
    kept = stored(dealt.withColumn("_at", place))
    part = F.shiftright("_at", 33)
    counts = kept.groupBy(group, part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(group)).alias(f"{name}_size"),
    )
    placed = kept.withColumn("_part", part).join(starts, [group, "_part"])
    return placed.withColumn(name, F.col("_at") - F.col("_first") + F.col("_start")).drop("_part", "_at", "_first", "_start")


def levels(leaves: DataFrame) -> list[DataFrame]:
    """The stored levels above ``leaves`` (tree, idx, size, digest); trees of one node have no level above."""
    out, below = [], leaves
    while True:
        runs = below.where("size > 1").groupBy("tree", F.expr(f"idx div {FAN}").alias("idx"))
        ordered = F.array_sort(F.collect_list(F.struct("idx", "digest")))  # one run: 16 at most
        joined = F.array_join(F.transform(ordered, lambda x: x["digest"]), "")
        size = F.expr(f"(min(size) + {FAN - 1}) div {FAN}").alias("size")
        above = stored(runs.agg(size, F.sha2(joined.cast("binary"), 256).alias("digest")))
        if above.isEmpty():
            forget(above)
            return out
        out.append(above)
        below = above


def missing(known: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Level by level, the nodes that proofs of the ``known`` leaves need and that do not follow from these leaves."""
    level = 0
    while size > 1:
        runs = np.unique(known // FAN)
        members = (runs[:, None] * FAN + np.arange(FAN)).ravel()
        yield level, np.setdiff1d(members[members < size], known, assume_unique=True)
        known, size, level = runs, -(-size // FAN), level + 1


def _wanted(trees: int):
    """Coordinates of the nodes each block asks for (one row per block in, its leaves as offsets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[np.ndarray, ...]] = []
            for row in batch.to_pylist():
                own = np.unique(np.asarray(row["offsets"], dtype=np.int64)) + row["block"] * BLOCK
                asked = [(row["tree"], level, idx) for level, idx in missing(own, row["size"])]
                asked += [(TOP, level, idx) for level, idx in missing(np.asarray([row["tree"]]), trees)]
                for tree, level, idx in asked:
                    same = [np.full(len(idx), x, dtype=np.int64) for x in (row["tree"], row["block"], tree, level)]
                    out.append((*same, idx))
            columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, dtype=np.int64)] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["tree", "block", "of", "level", "idx"])

    return run


class _Block:
    """The nodes of one block's paths: fetched ones, and those that follow from its leaves."""

    def __init__(self, tree: int, size: int, trees: int, fetched: dict[tuple[int, int, int], bytes], leaves: dict[int, bytes]) -> None:
        self.runs: list[dict[int, bytes]] = []  # by level of the whole path: run number to its digests
        known = self._climb(tree, size, fetched, leaves)
        self.subroot = next(iter(known.values()))
        self.depth = len(self.runs)
        self._climb(TOP, trees, fetched, {tree: self.subroot})
        self.tree = tree

    def _climb(self, of: int, size: int, fetched: dict[tuple[int, int, int], bytes], known: dict[int, bytes]) -> dict[int, bytes]:
        level = 0
        while size > 1:
            runs = {}
            for run in dict.fromkeys(i // FAN for i in known):
                members = range(run * FAN, min(run * FAN + FAN, size))
                runs[run] = b"".join(known[i] if i in known else fetched[of, level, i] for i in members)
            self.runs.append(runs)
            known = {run: sha256(digests).hexdigest().encode() for run, digests in runs.items()}
            size, level = -(-size // FAN), level + 1
        return known

    def path(self, idx: int) -> Iterator[tuple[bytes, int]]:
        """The run a leaf's path goes through at each level, and the path's place in it."""
        for level, runs in enumerate(self.runs):
            if level == self.depth:
                idx = self.tree
            yield runs[idx // FAN], idx % FAN * HEX
            idx //= FAN


def _prove(root: str, trees: int):
    """Rows of whole blocks, fetched nodes first, to the proof and the folded root of each leaf."""

    def settle(held: list[dict]) -> list[tuple]:
        fetched = {(r["of"], r["level"], r["idx"]): r["digest"].encode() for r in held if r["level"] is not None}
        leaves = [r for r in held if r["level"] is None]
        if not leaves:
            return []
        block = _Block(leaves[0]["tree"], leaves[0]["size"], trees, fetched, {r["idx"]: r["digest"].encode() for r in leaves})
        out = []
        for r in leaves:
            proof, digest = sha256(), r["claimed"].encode()
            for run, at in block.path(r["idx"]):
                before, after = run[:at], run[at + HEX :]
                proof.update(before + after)
                digest = sha256(before + digest + after).hexdigest().encode()
            folded = digest.decode()
            out.append((r["key"], r["digest"], block.subroot.decode(), root, proof.hexdigest(), folded, folded == root))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and (held[-1]["tree"], held[-1]["block"]) != (row["tree"], row["block"]):
                    out += settle(held)
                    held = []
                held.append(row)
            if out:
                yield as_batch(out, batch.schema.field("key").type)
            kind = batch.schema.field("key").type
        if held:
            yield as_batch(settle(held), kind)

    def as_batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(_PROOF)
        types = [kind, *[pa.string()] * 5, pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(_PROOF))

    return run


_PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


class Manifest:
    """The stored tree of a table: leaves with what is claimed of them, levels, root."""

    def __init__(self, docs: DataFrame, claimed: Column | None = None, fields: Sequence[str] = FIELDS, key: str = "doc_id", source: str = "source"):
        """``claimed`` is the leaf digest to be checked later, of the columns of ``docs`` (default: the true one)."""
        digest = leaf_digest([F.col(f) for f in fields])
        rows = docs.select(
            F.col(key).alias("key"),
            F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("group"),
            digest.alias("digest"),
            (digest if claimed is None else claimed).alias("claimed"),
        )
        placed = positions(rows, "group", ["key", "digest"], "idx")
        sources = placed.groupBy("group").agg(F.first("idx_size").alias("size"))
        numbered = positions(sources.withColumn("one", F.lit(0)), "one", ["group"], "tree").drop("one", "tree_size")
        self.leaves = stored(
            placed.join(numbered.drop("size"), "group").select("tree", "idx", F.col("idx_size").alias("size"), "key", "digest", "claimed")
        )
        self.trees = numbered.count()
        self.levels = levels(self.leaves.select("tree", "idx", "size", "digest"))
        tops = [level.where("size = 1") for level in [self.leaves.select("tree", "idx", "size", "digest"), *self.levels]]
        subroots = tops[0]
        for top in tops[1:]:
            subroots = subroots.union(top)
        self.subroots = stored(subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(self.trees).cast("long").alias("size"), "digest"))
        self.above = levels(self.subroots)
        last = self.above[-1] if self.above else self.subroots
        found = last.select("digest").head()
        self.root: str | None = found["digest"] if found else None

    def nodes(self, of: DataFrame) -> DataFrame:
        """The nodes at the coordinates ``of`` (columns of, level, idx and any others); levels nobody asks for are not read."""
        asked = {(r["top"], r["level"]) for r in of.select((F.col("of") == TOP).alias("top"), "level").distinct().collect()}
        tables = {(False, i): t for i, t in enumerate([self.leaves, *self.levels])}
        tables |= {(True, i): t for i, t in enumerate([self.subroots, *self.above])}
        known = None
        for (top, level), table in tables.items():
            if (top, level) in asked:
                part = table.select(F.col("tree").alias("of"), F.lit(level).cast("long").alias("level"), "idx", "digest")
                known = part if known is None else known.union(part)
        if known is None:
            return of.withColumn("digest", F.lit(None).cast("string"))
        return of.join(known, ["of", "level", "idx"])

    def proofs(self, chosen: DataFrame | None = None) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every leaf, or of the ``chosen`` rows of ``leaves``."""
        rows = (self.leaves if chosen is None else chosen).withColumn("block", F.expr(f"idx div {BLOCK}"))
        kind = rows.schema["key"].dataType.simpleString()
        text = ", ".join(f"{name} string" for name in _PROOF[1:-1])
        spark = rows.sparkSession
        if self.root is None:
            return spark.createDataFrame([], f"doc_id {kind}, {text}, verified boolean")
        offsets = F.collect_list((F.col("idx") % BLOCK).cast("int")).alias("offsets")  # a block: 4,096 at most
        blocks = rows.groupBy("tree", "block").agg(F.first("size").alias("size"), offsets)
        asked = stored(blocks.mapInArrow(_wanted(self.trees), "tree long, block long, of long, level long, idx long"))
        fetched = self.nodes(asked)
        whole = rows.unionByName(fetched, allowMissingColumns=True)
        dealt = whole.repartition(shuffle_partitions(spark), "tree", "block").sortWithinPartitions("tree", "block", "level", "idx")
        return dealt.mapInArrow(_prove(self.root, self.trees), f"doc_id {kind}, {text}, verified boolean")


def tampered_leaf(fields: Sequence[str] = FIELDS, key: str = "doc_id", text: str = "text", step: int = 5) -> Column:
    """The leaf of a row whose text is lower-cased where ``step`` divides the CRC-32 of its id; else its true leaf."""
    hit = F.coalesce(F.crc32(F.col(key).cast("string")) % step == 0, F.lit(False))
    changed = F.when(hit, lower_ascii(F.col(text))).otherwise(F.col(text))
    return leaf_digest([changed if f == text else F.col(f) for f in fields])
