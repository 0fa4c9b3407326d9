"""SimHash links and line alignment against brute force."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lakeworks.llm import components, linededup, simhash


def plain_fingerprint(text):
    import re

    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, limit=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= limit:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints_and_components_match_brute_force(spark):
    rng = random.Random(3)
    vocabulary = [f"Wörd{i}" for i in range(300)]
    texts = [None, "", " \t\n ", "one", "One two", "a b c d", "A B C D"]
    for _ in range(40):
        words = rng.choices(vocabulary, k=rng.randint(60, 300))
        for _ in range(rng.randint(1, 5)):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "  ", "\n"]).join(copy))
    docs = spark.createDataFrame([(i, t, 1, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n int, fp string")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("f"), "component_id").collect()}
    fps = [plain_fingerprint(t) for t in texts]
    assert [got[i]["f"] for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    assert [got[i]["component_id"] for i in range(len(texts))] == plain_components(fps)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_links_keep_what_close_fingerprints_connect(spark, monkeypatch):
    monkeypatch.setattr(simhash, "INDEX_BLOCK", 50)
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(500):  # a crowd around one fingerprint
        x = centre
        for _ in range(rng.randint(0, 7)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    signed = np.asarray(fps, dtype=np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components.components(simhash.links(table)).collect()}
    want = plain_components(fps)
    groups, other = {}, {}
    for x, w in zip(signed, want, strict=True):
        groups.setdefault(roots.get(x, x), set()).add(x)
        other.setdefault(w, set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, other.values()))


def test_thresholds_are_the_cheapest():
    rng = np.random.default_rng(0)
    costs = [np.sort(rng.random((20, 5)), axis=1) for _ in range(3)]
    chosen = simhash.thresholds(costs, 5)
    for r in range(20):
        best = min(
            sum(costs[i][r, k] for i, k in enumerate((a, b, 5 - a - b)))
            for a in range(5) for b in range(5) if 0 <= 5 - a - b < 5
        )
        assert abs(sum(costs[i][r, chosen[r, i] + 1] for i in range(3)) - best) < 1e-12
        assert chosen[r].sum() == 2


def test_long_chain_is_one_component(spark):
    table = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components.components(table).collect()}
    assert all(roots[i] == 0 for i in range(1, 201)) and roots[501] == 500


def plain_patience(a, b):
    """By recursion: common ends, then unique common lines, then what lies between."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(0, 0)] + [(i + 1, j + 1) for i, j in plain_patience(a[1:], b[1:])]
    if a[-1] == b[-1]:
        return plain_patience(a[:-1], b[:-1]) + [(len(a) - 1, len(b) - 1)]
    unique = [(i, b.index(x)) for i, x in enumerate(a) if a.count(x) == 1 and b.count(x) == 1]
    best = []
    for mask in range(1 << len(unique)):
        some = [unique[k] for k in range(len(unique)) if mask >> k & 1]
        if all(p[1] < q[1] for p, q in zip(some, some[1:])) and len(some) > len(best):
            best = some
    if not best:
        return []
    out, ends = list(best), [(-1, -1), *best, (len(a), len(b))]
    for (i0, j0), (i1, j1) in zip(ends, ends[1:]):
        out += [(i0 + 1 + i, j0 + 1 + j) for i, j in plain_patience(a[i0 + 1 : i1], b[j0 + 1 : j1])]
    return sorted(out)


def test_patience_aligns_as_many_lines():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(12) for _ in range(rng.randrange(9))]
        b = [rng.randrange(12) for _ in range(rng.randrange(9))]
        got = linededup.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))
        assert (len(got) > 0) == (len(plain_patience(a, b)) > 0)


def line(i):
    return f"this is the telling line number {i}"


def test_later_documents_lose_common_blocks(spark):
    docs = [
        (1, "\n".join(map(line, range(5)))),
        (2, "\n".join([line(9), line(1), "short", line(2), line(8)])),
        (3, "\n".join([line(1), line(2), line(9), line(7)])),
        (4, "short\nother"), (5, None), (6, ""), (7, "\n".join(map(line, range(5)))), (7, "\n".join(map(line, range(5)))),
        (None, line(0)),
    ]
    rows = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, id int")
    got = sorted(((r["doc_id"] or 99, r["text"], r["n_removed"]) for r in linededup.dedup_lines(rows).collect()), key=str)
    want = [
        (1, docs[0][1], 0), (2, "\n".join([line(9), "short", line(8)]), 2), (3, "\n".join([line(9), line(7)]), 2), (4, "short\nother", 0),
        (5, None, 0), (6, "", 0), (7, "", 5), (7, "", 5), (99, "", 1),
    ]
    assert got == sorted(want, key=str)
    assert linededup.dedup_lines(rows.limit(0)).collect() == []
