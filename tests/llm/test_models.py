"""Classifiers by held-out accuracy and odd rows; decontamination against brute force; the pipeline's stages."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeworks.llm import decontaminate, quality, queries, simhash, toxicity

SF_DIR = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int, text string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"


@pytest.fixture(scope="module")
def corpus(spark):
    """Plain and shouted texts, some with harsh words; labels follow the text."""
    rng = random.Random(0)
    vocabulary = [f"word{'abcdefghij'[i % 10]}{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(800):
        body = rng.choices(vocabulary, k=rng.randint(20, 80))
        bad, harsh = i % 5 == 0, i % 7 == 0
        if harsh:
            body[rng.randrange(len(body))] = rng.choice(["vile", "nasty", "awful"])
        text = " | ".join(body) if bad else " ".join(body)
        docs.append((i, text, "en", "s", len(text), 0.5))
        labels.append((i, int(not bad), int(harsh), "clash"))
    docs += [(None, "no id", None, None, 0, None), (900, None, None, None, None, None), (901, "", None, None, 0, None), (3, docs[3][1], "en", "s", 0, None)]
    labels += [(None, 1, 1, None), (902, 1, 0, None), (5, None, None, None), (3, 1, 0, None)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize(("classify", "label"), [(quality.classify, "quality"), (toxicity.classify, "toxic")])
def test_held_out_accuracy_and_odd_rows(spark, corpus, classify, label):
    docs, labels = corpus
    rows = classify(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in rows)
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    held = [r for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert len(held) > 100
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert classify(docs.limit(0), labels).collect() == []
    assert len(classify(docs, labels.limit(0)).collect()) == docs.count()


def test_held_out_rows_teach_nothing(spark, corpus):
    docs, labels = corpus
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    one = {r["doc_id"]: r["score"] for r in quality.classify(docs, labels).collect()}
    two = {r["doc_id"]: r["score"] for r in quality.classify(docs, flipped).collect()}
    assert one == two


def test_index_finds_the_exact_nearest():
    rng = random.Random(2)
    terms = [f"t{i}" for i in range(12)]
    idf = np.asarray([1 + 0.3 * i for i in range(12)])
    rows = []
    for i in range(700):
        chosen = sorted(rng.sample(range(12), rng.randint(1, 5)))
        rows.append((i, int(1 in chosen), tuple((t, rng.randint(1, 3)) for t in chosen)))
    index = toxicity.build(rows, terms, idf)
    vectors = sorted({v for _, _, v in rows})
    dense = np.zeros((len(vectors), 12))
    for i, v in enumerate(vectors):
        dense[i, [t for t, _ in v]] = index.weights(v)
    for v in vectors[:60]:
        query = np.zeros(12)
        query[[t for t, _ in v]] = index.weights(v)
        near, cosine = index.nearest(v, 15)
        assert np.allclose(cosine, np.sort(dense @ query)[::-1][:15])
        assert np.allclose(dense[near] @ query, cosine)


def test_tables_add_up_to_the_truth():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)  # only a pair can tell
    model = quality.boost(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_common_subsequence_matches_the_table():
    rng = random.Random(9)
    for _ in range(200):
        a, b = [rng.randrange(5) for _ in range(rng.randrange(12))], [rng.randrange(5) for _ in range(rng.randrange(12))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, p in enumerate(a):
            for j, q in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if p == q else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_words(a, b) == table[-1][-1]


def test_leaks_and_paraphrases_are_found(spark):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=30)) + ". The answer is " + " ".join(rng.choices(vocabulary, k=5)) + ".") for i in range(20)]
    docs, want = [], set()
    for i in range(200):
        body = rng.choices(vocabulary, k=rng.randint(50, 400))
        if i % 10 == 0:
            item, text = rng.choice(items)
            own = text.upper().split() if i % 20 else text.split()
            for _ in range(4):  # replaced and dropped words
                own[rng.randrange(len(own) - 9)] = rng.choice(vocabulary)
            del own[3]
            at = rng.randrange(len(body))
            body[at:at] = own
            want.add((i, item))
        docs.append((i, " ".join(body), "x"))
    docs += [(500, None, "x"), (501, "", "x"), (None, items[0][1], "x")]
    want.add((None, 0))
    rows = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*items, (None, "x"), (77, None), (78, "")], "item_id long, text string")
    got = decontaminate.leaks(rows, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert decontaminate.leaks(rows, bench.limit(0)).collect() == []
    assert decontaminate.leaks(rows.limit(0), bench).collect() == []


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = spark.createDataFrame(stage(spark, before, SF_DIR).toPandas()) if name != "packing" else stage(spark, before, SF_DIR)
        if name != "packing":
            assert after.columns == docs.columns
            assert 0 < after.count() <= before.count()
        if name == "near duplicates":
            again = simhash.near_duplicates(after).groupBy("component_id").count()
            assert again.where("count > 1").count() == 0
        if name == "decontamination":
            bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
            assert decontaminate.leaks(after, bench).count() == 0
        if name == "packing":
            assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()}
        before = after


def test_registered_names():
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in queries.QUERIES}
