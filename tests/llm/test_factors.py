"""Repeated word windows against brute force over all windows."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from lakeworks.llm import factors, queries

WINDOW = factors.WINDOW


def covered(documents, window=WINDOW):
    seen = Counter(tuple(d[i : i + window]) for d in documents for i in range(len(d) - window + 1))
    out = []
    for d in documents:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i : i + window])] > 1:
                gone[i : i + window] = True
        out.append(gone)
    return out


def brute(texts):
    documents = [(t or "").encode().split() for t in texts]
    rows = []
    for d, gone in zip(documents, covered(documents), strict=True):
        kept = b" ".join(w for w, g in zip(d, gone, strict=True) if not g)
        rows.append((len(d), int(gone.sum()), sha256(kept).hexdigest()))
    return rows


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["ab", "c", "é", "déf", "g", "h1", "K", "k"])
    prose = lambda n: [word() for _ in range(n)]
    passages = [prose(rng.randint(30, 70)) for _ in range(5)]
    texts = [None, "", " \t\n ", "short", "x " * 300, "ab c " * 60, " ".join(prose(120))]
    texts += [texts[-1], texts[-1].replace(" ", "\n"), " ".join(texts[-1].split()[3:40]), " ".join(prose(34))]
    texts.append(texts[-1])
    for _ in range(70):
        parts = prose(rng.randint(1, 40))
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            cut = rng.randint(0, 20)
            parts += (passage[cut:] if rng.random() < 0.5 else passage[: len(passage) - cut]) + prose(rng.randint(0, 20))
        texts.append(" ".join(parts))
    copy = prose(200)
    for _ in range(10):
        changed = list(copy)
        changed[rng.randrange(len(copy))] = "zz"
        texts.append(" ".join(changed))
    return texts


@pytest.mark.parametrize(("seed", "most"), [(0, 2000), (1, 5), (2, 1)])
def test_spans_match_brute_force(spark, monkeypatch, seed, most):
    monkeypatch.setattr(factors, "BLOCK_PIECES", most)
    texts = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, core string, k1 int")
    rows = factors.duplicate_spans(docs).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows}
    assert [got[i] for i in range(len(texts))] == brute(texts)
    if seed == 0:
        documents = [(t or "").encode().split() for t in texts]
        for r in rows:
            gone = np.zeros(len(documents[r["doc_id"]]), dtype=bool)
            for lo, hi in zip(r["bounds"][::2], r["bounds"][1::2], strict=True):
                gone[lo:hi] = True
            assert (gone == covered(documents)[r["doc_id"]]).all()
        assert factors.duplicate_spans(docs.limit(0)).collect() == []


def test_hot_passage_is_dealt_out(spark, monkeypatch):
    """One passage of half a window in every text, with different words around it in most."""
    monkeypatch.setattr(factors, "BLOCK_PIECES", 40)
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(18)]
    sides = [[f"q{rng.randrange(4)}" for _ in range(30)] for _ in range(6)]
    texts = []
    for i in range(400):
        near = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 30))]
        left, right = (rng.choice(sides)[: rng.randint(0, 30)] if rng.random() < 0.6 else near for _ in range(2))
        texts.append(" ".join([*left, *passage, *right, str(i)]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id string, text string")
    got = {int(r["doc_id"]): (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in factors.duplicate_spans(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_parse_matches_windows():
    rng = random.Random(5)
    for _ in range(300):
        window = rng.randint(2, 6)
        pieces = [[rng.randrange(rng.choice([2, 4])) for _ in range(rng.randint(0, 25))] for _ in range(rng.randint(1, 6))]
        got = [np.zeros(len(p), dtype=bool) for p in pieces]
        for i, lo, hi in factors.repeated_windows(pieces, window):
            assert 0 <= lo < hi <= len(pieces[i])
            got[i][lo:hi] = True
        assert all((a == b).all() for a, b in zip(got, covered(pieces, window), strict=True)), (window, pieces)


def test_widened_anchors_serve_every_window():
    def served(a, b, left):
        """Whether the window with ``left`` words before the first of the anchor is reached to the end."""
        if a + b >= WINDOW:
            return a == left
        return any(x <= left and y <= WINDOW - left and served(x, y, left) for x, y in factors.widened(a, b))

    assert all(served(0, factors.GRAM, left) for left in range(WINDOW - factors.GRAM + 1))
    todo, deepest = [(0, factors.GRAM, 0)], 0
    while todo:
        a, b, depth = todo.pop()
        assert a + b <= WINDOW
        deepest = max(deepest, depth)
        if a + b < WINDOW:
            todo += [(*pair, depth + 1) for pair in factors.widened(a, b)]
    assert deepest <= 6


def test_anchor_in_every_window():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 5, 3000).astype(np.uint64)
    place, _ = factors.anchors(hashes)
    for start in range(len(hashes) - WINDOW + 1):
        assert np.any((place >= start) & (place + factors.GRAM <= start + WINDOW))


def test_query_on_the_given_table(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in queries.QUERIES["op11_factors"](spark, small).collect()}
    assert [got[r["doc_id"]] for r in rows] == brute([r["text"] for r in rows])
