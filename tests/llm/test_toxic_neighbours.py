"""Toxicity over the whole vocabulary: near copies without any telling word, ids of other types, blocks left unopened."""

import random
import zlib

import numpy as np

from lakeworks.llm import toxicity


def held_out(name):
    return zlib.crc32(str(name).encode()) % 4 == 2


def test_near_copies_of_toxic_examples_without_telling_words(spark):
    """Groups of toxic texts share no word with each other; the held-out copies still find their group."""
    rng = random.Random(11)
    docs, labels, group_of = [], [], {}
    for i in range(900):
        name, toxic = f"d{i}", i % 6 == 0
        # Toxic texts come in groups of about six with words of their own, clean ones from a common stock.
        stock = [f"g{i // 36}w{k}" for k in range(40)] if toxic else [f"w{k}" for k in range(600)]
        body = stock[:38] + [rng.choice(stock)] if toxic else rng.choices(stock, k=40)
        group_of[name] = i // 36 if toxic else None
        docs.append((name, " ".join(body), "clash"))
        labels.append((name, int(toxic)))
    docs += [(None, "no id", None), ("empty", "", None), ("null", None, None), ("new", "zzz", None)]
    frame = spark.createDataFrame(docs, "doc_id string, text string, _label string")
    marks = spark.createDataFrame(labels, "doc_id string, toxic int")
    rows = {r["doc_id"]: r for r in toxicity.classify(frame, marks).collect()}
    assert len(rows) == len(docs)
    copies = [n for n, g in group_of.items() if g is not None and held_out(n)]
    known = {g for n, g in group_of.items() if g is not None and not held_out(n)}
    assert len(copies) > 20
    for name in copies:
        if group_of[name] in known:
            assert not rows[name]["terms"] and rows[name]["predicted"] == 1
            assert {group_of[n] for n in rows[name]["neighbours"]} == {group_of[name]}
    clean = [n for n, g in group_of.items() if g is None and held_out(n)]
    assert np.mean([rows[n]["predicted"] for n in clean]) < 0.03
    assert all(rows[n]["neighbours"] == [] for n in ("empty", "null", "new"))


def test_unopened_blocks_hold_no_nearer_entry():
    rng = random.Random(3)
    idf = np.asarray([1 + rng.random() * 4 for _ in range(300)])
    terms = [f"t{i}" for i in range(300)]
    rows = []
    for i in range(1500):
        # Vectors of one topic share words and stand together, so that bounds can close blocks.
        low = 60 * (i % 5)
        rows.append((i, i % 2, tuple((t, rng.randint(1, 3)) for t in sorted(rng.sample(range(low, low + 60), rng.randint(1, 12))))))
    index = toxicity.build(rows, terms, idf)
    vectors = sorted({v for _, _, v in rows})
    dense = np.zeros((len(vectors), 300))
    for i, v in enumerate(vectors):
        dense[i, [t for t, _ in v]] = index.weights(v)
    for v in rng.sample(vectors, 80):
        query = np.zeros(300)
        query[[t for t, _ in v]] = index.weights(v)
        near, cosine = index.nearest(v, 15)
        exact = dense @ query
        assert np.allclose(cosine, np.sort(exact)[::-1][:15]) and np.allclose(exact[near], cosine)


def test_words_are_what_the_pattern_finds_and_come_by_bytes():
    """Letters, marks, digits and blanks of many scripts; the pattern itself is not run over the text."""
    odd = "Grüße_1 don't\x85a b ćd İstanbul x中文 —\x1fend​z ½ ①"
    for text in (odd, odd.encode("ascii", "ignore").decode(), "", " ", "—"):
        assert toxicity.words(text) == toxicity.WORD.findall(text.lower())
    assert toxicity.words(None) == []
    assert toxicity.words.__code__.co_names.count("findall") == 0
