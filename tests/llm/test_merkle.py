"""Merkle manifest against a recursive rebuild of the whole tree."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from lakeworks.llm import merkle, queries

FAN = merkle.FAN


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(nodes, at, own):
    """Siblings of the node at ``at`` up to the top, the top, and the top folded from ``own``."""
    siblings = []
    while len(nodes) > 1:
        run = at // FAN * FAN
        members = nodes[run : run + FAN]
        siblings += members[: at - run] + members[at - run + 1 :]
        own = digest("".join([*members[: at - run], own, *members[at - run + 1 :]]))
        nodes = [digest("".join(nodes[i : i + FAN])) for i in range(0, len(nodes), FAN)]
        at //= FAN
    return siblings, nodes[0], own


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        own = sorted(by_source[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[s] = [(r, leaf(r, r["text"])) for r in own]
    tops = [climb([x for _, x in trees[s]], 0, "")[1] for s in order]
    out = []
    for i, s in enumerate(order):
        for at, (row, true) in enumerate(trees[s]):
            text = row["text"]
            if row["doc_id"] is not None and crc32(str(row["doc_id"]).encode()) % 5 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            low, subroot, folded = climb([x for _, x in trees[s]], at, leaf(row, text))
            high, root, folded = climb(tops, i, folded)
            out.append((row["doc_id"], true, subroot, root, digest("".join(low + high)), folded, folded == root))
    return out


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree int, digest string"


def corpus(seed, n):
    rng = random.Random(seed)
    sources = [None, "", "a", "B", "é", "zz", *[f"s{i}" for i in range(30)]]
    weights = [1, 1, 300, 20, 20, 3, *[1] * 30]
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "Small Text", "ÄÖ Text", "X" * 5000, f"lower {i}", f"Mixed {i}"])
        size = len(text) if text is not None and rng.random() < 0.9 else None
        rows.append((i * 7 if rng.random() < 0.98 else None, rng.choices(sources, weights)[0], rng.choice([None, "de"]), size, text, 1, "x"))
    return rows + rng.sample(rows, min(len(rows), 5))


@pytest.mark.parametrize(("seed", "n", "block"), [(0, 1, 3), (1, 3, 3), (2, 700, 1), (3, 700, 2), (4, 5200, 3)])
def test_proofs_match_rebuild(spark, monkeypatch, seed, n, block):
    monkeypatch.setattr(merkle, "BLOCK", FAN**block)
    rows = corpus(seed, n)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = merkle.Manifest(docs, claimed=merkle.tampered_leaf()).proofs().collect()
    assert by_id(got) == by_id(brute([r.asDict() for r in docs.collect()]))


def test_chosen_leaves_need_few_nodes(spark):
    rows = [r for r in corpus(9, 900) if r[0] is not None]
    manifest = merkle.Manifest(spark.createDataFrame(rows, SCHEMA))
    whole = {(r["doc_id"], r["leaf"]): tuple(r) for r in manifest.proofs().collect()}
    some = manifest.proofs(manifest.leaves.where("key % 5 = 0")).collect()
    assert some and all(tuple(r) == whole[r["doc_id"], r["leaf"]] and r["verified"] for r in some)


def test_missing_is_least():
    rng = np.random.default_rng(2)
    for size in (1, 2, 16, 17, 300, 5000):
        known = np.unique(rng.integers(0, size, 20))
        held = {(0, int(i)) for i in known}
        for level, asked in merkle.missing(known, size):
            width = -(-size // FAN**level)
            on_paths = {int(i) // FAN**level for i in known}
            needed = {j for i in on_paths for j in range(i // FAN * FAN, min(i // FAN * FAN + FAN, width))}
            assert set(asked.tolist()) == needed - on_paths
            held |= {(level + 1, i // FAN) for i in on_paths}
        assert len(held) >= 1


def test_empty_table(spark):
    assert merkle.Manifest(spark.createDataFrame([], SCHEMA)).proofs().collect() == []


def test_query_on_the_given_table(spark, small):
    rows = [r.asDict() for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert by_id(queries.QUERIES["op12_manifest"](spark, small).collect()) == by_id(brute(rows))
