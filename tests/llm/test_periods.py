"""Periodic runs against brute force over all periods."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from lakeworks.llm import periods, queries


def brute_runs(words):
    """(start, end, smallest period) of all maximal stretches of at least max(12, 2q)."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < len(same):
            if not same[i]:
                i += 1
                continue
            j = i
            while j < len(same) and same[j]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)  # periods rise, so the smallest stays
            i = j
    return sorted((s, e, q) for (s, e), q in found.items())


def brute_row(text, key):
    words = (text or "").encode().split()
    n = len(words)
    h = crc32(str(key).encode()) if key is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(((s, e - s, q) for s, e, q in brute_runs(words)), key=lambda r: (r[0], r[2]))
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, milli, sha256(listed.encode()).hexdigest(), sha256(kept).hexdigest())


def sequences(rng):
    kind = rng.randrange(6)
    n = rng.randint(0, 90)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        return [rng.randrange(3) for _ in range(n)]
    if kind == 2:
        return [0] * n
    if kind == 3:  # repeated pieces with slips
        piece = [rng.randrange(3) for _ in range(rng.randint(1, 20))]
        out = (piece * 12)[:n]
        for _ in range(rng.randint(0, 2)):
            if out:
                out[rng.randrange(len(out))] = 7
        return out
    if kind == 4:  # two periodic stretches that meet: many squares around the seam
        return [0, 1] * (n // 4) + [0] + [1, 0] * (n // 4)
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("seed", range(8))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(120):
        numbers = sequences(rng)
        got = list(zip(*(x.tolist() for x in periods.runs(np.asarray(numbers, dtype=np.int64))), strict=True))
        assert sorted(got) == brute_runs(numbers), numbers


def test_range_successor():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 100):
        values = rng.permutation(n)
        tree = periods.Wavelet(values)
        lo = rng.integers(0, n, 200)
        hi = np.minimum(n, lo + rng.integers(0, n + 1, 200))
        least = rng.integers(0, n, 200)
        want = [min((v for v in values[a:b].tolist() if v >= m), default=-1) for a, b, m in zip(lo, hi, least, strict=True)]
        assert tree.successor(lo, hi, least).tolist() == want


def test_suffix_array_and_extensions():
    rng = random.Random(4)
    for _ in range(60):
        numbers = sequences(rng) or [0]
        suffixes = periods.Suffixes(np.asarray(numbers))
        assert suffixes.order.tolist() == sorted(range(len(numbers)), key=lambda i: numbers[i:])
        a, b = sorted(rng.sample(range(len(numbers)), 2)) if len(numbers) > 1 else (0, 0)
        if a == b:
            continue
        ahead = next((k for k in range(len(numbers) - b) if numbers[a + k] != numbers[b + k]), len(numbers) - b)
        behind = next((k for k in range(a) if numbers[a - 1 - k] != numbers[b - 1 - k]), a)
        pair = np.asarray([a]), np.asarray([b])
        assert (suffixes.ahead(*pair)[0], suffixes.behind(*pair)[0]) == (ahead, behind)


@pytest.mark.parametrize("batch", [1, 50, 1 << 17])
def test_documents(spark, monkeypatch, batch):
    rng = random.Random(batch)
    texts = [None, "", " \t\n", "eins", "a " * 40, "x y " * 30 + " z " * 20]
    texts += [" ".join("abc"[c % 3] + "é" * (c > 2) for c in sequences(rng)) for _ in range(60)]
    docs = [(i, t, 1) for i, t in enumerate(texts)] + [(5, texts[5], 1), (None, texts[5], 2)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_runs int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    monkeypatch.setattr(periods, "BATCH_WORDS", batch)
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = [(r["doc_id"], tuple(r[c] for c in names)) for r in periods.periodic_runs(frame, plant=True).collect()]
    want = [(i, brute_row(t, i)) for i, t, _ in docs]
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert order(got) == order(want)
    assert periods.periodic_runs(frame.limit(0)).collect() == []
    text_ids = frame.selectExpr("'k' as doc_id", "text")
    assert {r["doc_id"] for r in periods.periodic_runs(text_ids).collect()} == {"k"}


def test_query_on_the_given_table(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    rows = {r["doc_id"]: r for r in queries.QUERIES["op13_periods"](spark, small).collect()}
    assert set(rows) == set(docs)
    for key, text in docs.items():
        if len((text or "").split()) <= 250:
            assert tuple(rows[key])[1:] == brute_row(text, key)
