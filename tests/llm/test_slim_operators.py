"""Sharding, packing, neighbours and license scan against brute force on small and odd tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeworks.llm import licenses, neighbours, packing, queries, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string"
ODD = [
    (1, "one two three", "en", "a", 0, "x"),
    (1, "one two three", "en", "a", 0, "x"),
    (2, None, None, None, None, None),
    (None, "no id", None, "b", 1, None),
    (4, "", "en", "b", 0, "y"),
    (5, "word " * 9000, "en", "a", 0, "y"),
    (6, "Ünïcode\twith  runs \n\n and <|endoftext|> inside", "de", "", 0, "y"),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def many(spark, n=600):
    rows = [(i, f"text {i % 7}", "en", "hot" if i % 3 == 0 else f"s{i % 20}", 0, None) for i in range(n)]
    return spark.createDataFrame(rows, DOCS)


def test_shards_hold_the_mixture(spark):
    rows = sharding.shard(many(spark), 24).collect()
    assert len(rows) == 600
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(24):
        own = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["source"] == "hot" for r in own) - 600 / 3 / 24) <= 3
    again = sharding.shard(many(spark).repartition(5), 24).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows) == sorted(
        (r["doc_id"], r["shard"], r["slot"]) for r in again
    )


def test_shard_odd_rows(spark, odd):
    rows = sharding.shard(odd, 3, carry=["lang"]).collect()
    assert len(rows) == len(ODD)
    null = next(r for r in rows if r["doc_id"] == 2)
    assert (null["size"], null["text_crc32"]) == (8, 0)
    assert next(r for r in rows if r["doc_id"] == 6)["text_crc32"] == zlib.crc32(ODD[6][1].encode())
    assert sharding.shard(odd.limit(0), 3).collect() == []


def test_packing_is_an_exact_round_trip(spark, odd):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    whole = Tokenizer.from_file(path)
    packed = packing.pack_documents(odd, path, capacity=64, with_ids=True).cache()
    rows = packed.collect()
    parts = defaultdict(list)
    for r in rows:
        parts[r["doc_id"], r["doc_tokens"]].append(r)
    for name, text in {(d, t) for d, t, *_ in ODD}:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(parts[name, len(ids)], key=lambda r: (r["start"], r["sequence_id"]))
        copies = len(own) // math.ceil(len(ids) / 64)
        assert [i for r in own[::copies] for i in r["ids"]] == ids
        assert all(r["ids_crc32"] == zlib.crc32(np.asarray(r["ids"], "<u4").tobytes()) for r in own)
    for window in packing.sequences(packed).collect():
        own = sorted((r for r in rows if r["sequence_id"] == window["sequence_id"]), key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(r["length"] for r in own[:i]) for i in range(len(own))]
        assert len(window["ids"]) == sum(r["length"] for r in own) <= 64
    assert packing.pack_documents(odd.limit(0), path).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_fullest_window_is_the_best_of_all(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(41, dtype=np.int64)
    for length in rng.integers(1, 21, 12):
        counts[length] += 1
    longest = int(np.flatnonzero(counts)[-1])
    chosen = packing._fullest(counts, longest, 40)
    assert all(counts[length] >= times for length, times in chosen.items()) and chosen[longest] >= 1
    rest = [length for length in range(41) for _ in range(counts[length] - (length == longest))]
    sums = {longest}
    for x in rest:
        sums |= {s + x for s in sums if s + x <= 40}
    assert sum(length * times for length, times in chosen.items()) == max(sums)


def test_plan_uses_each_piece_once():
    counts = {2048: 3, 1500: 7, 548: 9, 7: 100, 1: 5}
    plan = packing.plan_windows(counts)
    windows = Counter()
    for length, n in counts.items():
        at = [i for i in range(len(plan["length"])) if plan["length"][i] == length]
        ends = [*[int(plan["rank"][i]) for i in at[1:]], n]
        for i, end in zip(at, ends, strict=True):
            used = end - int(plan["rank"][i])
            assert used % plan["times"][i] == 0
            for rep in range(used // int(plan["times"][i])):
                windows[int(plan["sequence"][i]) + rep] += length * int(plan["times"][i])
    assert max(windows.values()) <= 2048 and sum(windows.values()) == sum(k * v for k, v in counts.items())


def brute_neighbours(rows, step, k):
    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        good[i] = min(good.get(i, v), v)
    out = []
    for q in sorted(i for i in good if i % step == 0):
        near = [(-sum(a * b for a, b in zip(good[q], v, strict=True)), i) for i, v in good.items() if i != q and len(v) == len(good[q])]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(near)[:k])]
    return out


def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype("f4")]) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 400)]
    rows += [(400, None), (420, [0.0] * 8), (440, [float("nan")] * 8), (460, [None] * 8), (None, rows[0][1])]
    rows += [(480, [1.0, 2.0]), (481, [2.0, 1.0]), (7, [9.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = sorted(neighbours.nearest(table, F.col("vec_id") % 20 == 0, 20).collect())
    want = sorted(brute_neighbours(rows, 20, 20))
    assert [r[:3] for r in map(tuple, got)] == [w[:3] for w in want]
    assert np.allclose([r["score"] for r in got], [w[3] for w in want], atol=1e-9)
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 20 == 0, 20).collect() == []


PHRASES = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
TEXTS = [
    "Licensed under CC-BY-NC 4.0, and cc by cc by.",
    "GNU General Public License, version 3 or any later version. All rights reserved!",
    "Released under the MIT License.", "", None, "ÄCC BY", "plain words only", "all rights reserved " * 50,
    "Licensed under the Apache License, Version 2.0", "general public licence", "cc by",
]


def test_license_scan(spark):
    rows = licenses.scan(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()
    got = {r["doc_id"]: r for r in rows}
    for i, text in enumerate(TEXTS):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        at = [(k, p) for p in PHRASES for k in range(len(words)) if tuple(words[k : k + len(p)]) == p]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(at)), text
        assert (r["first_word"], r["last_word"]) == (
            (min(k for k, _ in at), max(k for k, _ in at)) if at else (None, None)
        )
        base = {PHRASES[p] for _, p in at}
        assert r["base_labels"] == ",".join(sorted(base))
        assert base <= set(r["labels"].split(",")) and r["labels"].split(",") == sorted(set(r["labels"].split(",")))
        assert 0 <= r["score"] <= 1
    assert got[0]["labels"] == "cc-by,cc-by-nc-4.0"
    assert got[1]["labels"] == "gpl,gpl-3.0-or-later,reserved,reserved-all"
    assert got[2]["labels"] == "mit" and got[8]["labels"] == "apache-2.0" and got[6]["labels"] == ""


def test_no_python_in_the_license_scan(spark, tmp_path):
    plan = licenses.scan(spark.createDataFrame([(1, "x")], "doc_id long, text string"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
