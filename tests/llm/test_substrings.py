"""Repeated byte strings against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lakeworks.llm import substrings

LENGTH = substrings.LENGTH


def brute(texts):
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + LENGTH] for d in datas for i in range(len(d) - LENGTH + 1))
    out = []
    for d in datas:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for i in range(len(d) - LENGTH + 1):
            if seen[d[i : i + LENGTH]] > 1:
                gone[i : i + LENGTH] = True
        spans = int((gone[1:] < gone[:-1]).sum())
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(60)[: rng.randint(190, 320)] for _ in range(6)]
    texts = [None, "", "short", "x" * 1000, "ab" * 400, prose(100)]
    texts += [texts[-1], texts[-1], texts[-1][10:260]]
    for _ in range(60):
        parts = [prose(rng.randint(5, 60))]
        for _ in range(rng.randint(0, 2)):
            passage = rng.choice(passages)
            cut = rng.randint(0, 60)
            parts += [passage[cut:] if rng.random() < 0.5 else passage[: len(passage) - cut], prose(rng.randint(1, 30))]
        texts.append("".join(parts))
    copy = prose(300)
    for _ in range(8):
        at = rng.randrange(len(copy) - 10)
        texts.append(copy[:at] + word() + copy[at + 5 :])
    return texts


@pytest.mark.parametrize(("seed", "many"), [(0, 10**9), (1, 10**9), (2, 3), (3, 1)])
def test_spans_match_brute_force(spark, monkeypatch, seed, many):
    texts = corpus(seed)
    monkeypatch.setattr(substrings, "MANY_ROWS", many)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, size string, k1 int")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["bounds"]) // 2, r["kept_sha256"]) for r in substrings.repeated_spans(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)
    if seed == 0:
        kept = {r["doc_id"]: r["kept"] for r in substrings.kept_texts(docs).collect()}
        assert all(hashlib.sha256(bytes(kept[i])).hexdigest() == got[i][3] for i in range(len(texts)))
        assert substrings.repeated_spans(docs.limit(0)).collect() == []


def test_interval_tree_holds_all_groups():
    rng = random.Random(3)
    for _ in range(100):
        words = sorted("".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in range(rng.randint(2, 9)))
        common = [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(words, words[1:])]
        want = set()
        for i in range(len(words)):
            for j in range(i + 1, len(words)):
                low = min(common[i:j])
                left = common[i - 1] if i else -1
                right = common[j] if j < len(common) else -1
                if low > 0 and left < low and right < low:
                    want.add((low, i, j))
        assert set(substrings.intervals(common)) == want


def test_repeats_match_pairs():
    rng = random.Random(5)
    for _ in range(60):
        n, alphabet = rng.randint(2, 40), "ab" if rng.random() < 0.5 else "abc"
        text = lambda k: "".join(rng.choices(alphabet, k=rng.randint(k // 2, k))).encode()
        left, right = [text(6) for _ in range(n)], [b"zz" + text(6) for _ in range(n)]
        common = lambda x, y: next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        want = set()
        for i in range(n):
            for j in range(n):
                e, r = common(left[i], left[j]), common(right[i], right[j])
                want |= {(i, x) for x in range(e + 1) if i != j and x + r >= 8}
        got = {(i, x) for i, e, r in substrings.repeats(left, right, 8, 2) for x in range(e + 1) if x + r >= 8}
        assert got == want


def test_anchor_in_every_window():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, 5000).astype(np.uint8)
    place, _, _ = substrings.anchors(data)
    for start in range(len(data) - LENGTH + 1):
        assert np.any((place >= start) & (place + substrings.GRAM <= start + LENGTH))
