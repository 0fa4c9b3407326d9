"""Filtering operators on tables whose further columns are called like names the operators use."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeworks.llm import decontaminate, linededup, simhash

CLASH = "_id long, _mark string, _gone int, n_removed string, _bad long, mark int, id int, gone int, doc string, fp int"
SCHEMA = f"doc_id long, text string, n_chars int, {CLASH}"


def rows_of(spark, texts):
    """(id, text) as documents with clashing columns."""
    rows = [(i, t, len(t or ""), 1, "m", 2, "given", 3, 4, 5, 6, "d", 7) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def body(rng, n=60):
    return " ".join(rng.choice(["red", "tree", "salt", "moon", "door", "glass", "wind", "iron"]) + str(rng.randrange(400)) for _ in range(n))


def kept(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_one_of_each_component(spark):
    rng = random.Random(5)
    base = [body(rng, 300) for _ in range(30)]
    texts = [(i, t) for i, t in enumerate(base)]
    for i in range(0, 30, 3):  # one word of 300 differs, or none
        texts.append((100 + i, base[i].replace(base[i].split()[7], "other", 1) if i % 2 else base[i]))
    texts += [(None, base[1]), (None, "lone text of no id at all"), (None, "lone text of no id at all"), (7, base[7]), (200, ""), (201, None)]
    ids = {t: simhash.fingerprint(t) for _, t in texts}
    names = sorted({(i is None, i, t) for i, t in texts}, key=lambda x: (x[0], x[1] or 0))
    group = {n: {n} for n in names}
    for a in names:
        for b in names:
            if (ids[a[2]] ^ ids[b[2]]).bit_count() <= simhash.LIMIT and group[a] is not group[b]:
                group[a] |= group[b]
                for n in group[a]:
                    group[n] = group[a]
    heads = {min(g, key=lambda x: (x[0], x[1] or 0)) for g in group.values()}
    got = simhash.one_of_each(rows_of(spark, texts))
    assert got.columns == rows_of(spark, []).columns
    assert kept(got) == sorted(((i, t) for _, i, t in heads), key=str)
    assert {r["n_removed"] for r in got.collect()} == {"given"}
    assert kept(simhash.one_of_each(rows_of(spark, []))) == []
    strings = spark.createDataFrame([("b", base[0]), ("a", base[0]), (None, base[0])], "doc_id string, text string")
    assert kept(simhash.one_of_each(strings)) == [("a", base[0])]


def test_lines_beside_clashing_columns(spark):
    line = "one line of at least five words"
    docs = rows_of(spark, [(1, f"{line}\nfirst own words stand here now"), (2, f"{line}\nsecond own words stand here now"), (3, None)])
    got = linededup.dedup_lines(docs)
    assert got.columns == [c for c in docs.columns if c != "n_removed"] + ["n_lines", "n_removed"]
    assert kept(got) == [(1, f"{line}\nfirst own words stand here now"), (2, "second own words stand here now"), (3, None)]
    assert {(r["doc_id"], r["n_removed"], r["_gone"], r["_id"]) for r in got.collect()} == {(1, 0, 2, 1), (2, 1, 2, 1), (3, 0, 2, 1)}
    stage = corpus_pipeline.without_repeated_lines(spark, docs, "")
    assert stage.columns == docs.columns and {r["n_removed"] for r in stage.collect()} == {"given"}


@pytest.mark.parametrize("kind", ["long", "string"])
def test_leaks_of_rows_without_id(spark, kind):
    rng = random.Random(9)
    item, clean = body(rng, 30), [body(rng, 80) for _ in range(4)]
    texts = [(None, f"{clean[0]} {item}"), (None, clean[1]), (None, None), (1, item), (1, clean[2]), (2, clean[3])]
    docs = rows_of(spark, texts).withColumn("doc_id", F.col("doc_id").cast(kind))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = decontaminate.without_leaks(docs, bench)
    two = 2 if kind == "long" else "2"
    assert kept(got) == sorted([(None, clean[1]), (None, None), (two, clean[3])], key=str)
    assert got.columns == docs.columns and {r["_bad"] for r in got.collect()} == {3}
