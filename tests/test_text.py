import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeworks.operators import chunking, retrieval, topk
from lakeworks.operators.intervals import points_in_intervals
from lakeworks.sources import views


def fixed(text, size, overlap):
    stride = size - overlap
    starts = [s for s in range(0, max(len(text), 1), stride) if s == 0 or s + overlap < len(text)]
    return [text[s : s + size] for s in starts] if text else []


@pytest.mark.parametrize("size,overlap", [(700, 100), (7, 3), (5, 0)])
def test_fixed_chunks_equal_slices(spark, small, size, overlap):
    texts = ["", "a", "ab\ncd" * 3, "x" * size, "y" * (size + 1), "z" * (2 * size - overlap), "ü中\U0001f600 \n" * 40, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {}
    for r in chunking.fixed_chunks(docs, size=size, overlap=overlap).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append(r.chunk_text)
    assert got == {i: fixed(t, size, overlap) for i, t in enumerate(texts) if t}


def chunks(text, size, overlap):
    return list(chunking.recursive_chunks(text, size, overlap))


def test_short_text_is_one_stripped_chunk():
    assert chunks("  one two  ", 700, 100) == ["one two"]
    assert chunks(" \n\n ", 700, 100) == []


def test_paragraphs_are_kept_together_and_long_ones_broken_at_words():
    assert chunks("aaaa\n\nbbbb\n\ncccc", 12, 0) == ["aaaa\n\nbbbb", "cccc"]
    assert chunks("aa bb cc dd", 5, 0) == ["aa bb", "cc", "dd"]
    assert chunks("aa\n\nbbbb bbbb", 7, 0) == ["aa", "bbbb", "bbbb"]
    assert chunks("abcdefghij", 4, 0) == ["abcd", "efgh", "ij"]


def test_overlap_repeats_the_last_pieces():
    assert chunks("a b c d e f", 5, 2) == ["a b c", "c d", "d e", "e f"]
    assert chunks("abcdefgh", 4, 2) == ["abcd", "cdef", "efgh"]


def in_order_and_whole(text, pieces):
    """Whether the pieces can be laid on the text in order with only white space left out.

    Repeated passages fit in several places, so every place a piece may take is followed."""
    ends = {(-1, 0)}
    for piece in pieces:
        starts = [m.start() for m in re.finditer(f"(?={re.escape(piece)})", text)]
        ends = {
            (s, max(covered, s + len(piece)))
            for last, covered in ends
            for s in starts
            if s > last and not text[covered:s].strip()
        }
    return any(not text[covered:].strip() for _, covered in ends)


def test_chunks_of_real_texts_keep_order_size_and_words(spark, small):
    docs = views.table(spark, small, "documents").select("doc_id", F.lit("s").alias("source"), F.col("text").alias("page_content"))
    out = chunking.split_documents(docs)
    assert out.columns == ["doc_id", "source", "chunk_no", "chunk_text"]
    got = {}
    for r in out.orderBy("doc_id", "chunk_no").collect():
        assert 0 < len(r.chunk_text) <= 700 and r.chunk_text == r.chunk_text.strip() and r.source == "s"
        assert r.chunk_no == len(got.setdefault(r.doc_id, []))
        got[r.doc_id].append(r.chunk_text)
    for r in docs.collect():
        assert in_order_and_whole(r.page_content, got.get(r.doc_id, [])), r.doc_id


def test_a_long_text_without_breaks_is_covered_whole(spark):
    docs = spark.createDataFrame([(1, "x" * 50_000), (2, None), (3, "")], "doc_id int, page_content string")
    rows = chunking.split_documents(docs).collect()
    assert {r.doc_id for r in rows} == {1} and sum(len(r.chunk_text) for r in rows) - 100 * (len(rows) - 1) == 50_000


def test_documents_are_cut_a_few_at_a_time(spark, monkeypatch):
    """A large Arrow batch leaves as many small ones, with nulls and types of the other columns as they came."""
    docs = spark.createDataFrame([], "n int, page_content string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, cut, schema: cut)
    cut = chunking.split_documents(docs)
    texts = [None if i % 7 == 0 else "" if i % 7 == 1 else f"word{i} " * 300 for i in range(500)]
    numbers = [None if i % 3 == 0 else i for i in range(500)]
    whole = pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(texts)], names=["n", "page_content"])
    parts = list(cut(iter([whole])))
    expected = [(n, i, c) for n, t in zip(numbers, texts) for i, c in enumerate(chunking.recursive_chunks(t or ""))]
    assert [tuple(r.values()) for p in parts for r in p.to_pylist()] == expected
    most = max(len(list(chunking.recursive_chunks(t or ""))) for t in texts)
    assert max(p.num_rows for p in parts) <= 64 * most and parts[0].schema.field("n").type == pa.int32()


def test_article_records(spark):
    df = spark.createDataFrame([(7, "t", ["a", "b c"]), (8, None, None), (9, "e", [])], "pmid long, title string, abstract array<string>")
    rows = retrieval.article_documents(df).orderBy("pmid").collect()
    assert [r.page_content for r in rows] == ["a b c", "No abstract available.", ""]
    assert rows[0].metadata.source == "https://pubmed.ncbi.nlm.nih.gov/7/" and rows[0].metadata.title == "t"


def test_article_metadata_travels_to_every_chunk(spark):
    records = spark.createDataFrame([(7, "t", ["one " * 200, "two " * 200])], "pmid long, title string, abstract array<string>")
    rows = chunking.split_documents(retrieval.article_documents(records)).collect()
    assert len(rows) > 1 and {(r.pmid, r.metadata.title, r.metadata.source) for r in rows} == {
        (7, "t", "https://pubmed.ncbi.nlm.nih.gov/7/")
    }


@pytest.fixture(scope="module")
def vectors(spark, small):
    return views.table(spark, small, "embeddings")


def brute_force(vectors, questions, k):
    rows = vectors.collect()
    ids, matrix = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    out = {}
    for q in questions.collect():
        distance = ((matrix - np.array(q.question_vector)) ** 2).sum(axis=1)
        order = np.lexsort((ids, distance))[:k]
        out[q.question_id] = [(int(ids[i]), pytest.approx(distance[i])) for i in order]
    return out


@pytest.mark.parametrize(("block", "pairs"), [(32 << 20, 1 << 21), (1500, 64)])
def test_nearest_equals_brute_force(spark, vectors, monkeypatch, block, pairs):
    monkeypatch.setattr(topk, "QUESTION_BYTES", block)
    monkeypatch.setattr(topk, "PAIRS", pairs)
    questions = retrieval.topic_questions(vectors)
    got = {}
    for r in retrieval.nearest(vectors, questions, 4).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append((r.vec_id, r.distance))
    assert got == brute_force(vectors, questions, 4)


def test_nearest_sorts_no_pairs(spark, vectors):
    plan = retrieval.nearest(vectors, retrieval.topic_questions(vectors), 3)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("MapInArrow", 1)
    assert "Window" in above and not any(word in below for word in ("Window", "Sort", "Join", "Generate"))


def test_nearest_with_odd_vectors_and_ties(spark):
    nan = float("nan")
    rows = [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [1.0, 0.0]), ("n", None), ("x", [nan, 0.0]), ("s", [1.0]), ("m", [None, 1.0]), ("z", [9.0, 9.0])]
    vectors = spark.createDataFrame(rows, "vec_id string, embedding array<float>")
    questions = spark.createDataFrame([("q", [1.0, 0.0]), ("none", None), ("far", [1e8, 1e8])], "question_id string, question_vector array<double>")
    got = [(r.question_id, r.vec_id, r["rank"]) for r in retrieval.nearest(vectors, questions, 2).orderBy("question_id", "rank").collect()]
    assert got == [("far", "z", 1), ("far", "a", 2), ("q", "a", 1), ("q", "b", 2)]
    assert retrieval.nearest(vectors, questions.limit(0), 2).collect() == []
    assert len(retrieval.nearest(vectors, questions, 50).collect()) == 8


def test_points_meet_the_intervals_that_hold_them(spark):
    rng = np.random.default_rng(1)
    spans = [(int(k), int(a), int(a + n)) for k, a, n in zip(rng.integers(0, 3, 80), rng.integers(0, 500, 80), rng.integers(0, 60, 80))]
    places = [(int(k), int(x)) for k, x in zip(rng.integers(0, 4, 200), rng.integers(0, 600, 200))]
    intervals = spark.createDataFrame(spans, "k long, start long, end long")
    points = spark.createDataFrame([*places, (None, 3), (1, None)], "k long, at long")
    for width in (7, 60, 10_000):
        got = sorted(map(tuple, points_in_intervals(points, intervals, "k", "at", "start", "end", width).select("k", "at", "start", "end").collect()))
        assert got == sorted((k, x, a, b) for k, x in places for j, a, b in spans if j == k and a <= x < b)


def test_contexts_are_chunks_at_the_hits(spark):
    text = "".join(f"{i:05d}" for i in range(600))
    docs = spark.createDataFrame([(1, text), (2, "short"), (3, ""), (4, None)], "doc_id long, text string")
    places = spark.createDataFrame([(10, 1, 0), (11, 1, 699), (12, 1, 700), (13, 1, 2999), (14, 2, 4), (15, 3, 0), (16, 4, 0)], "vec_id long, doc_id long, place long")
    hits = spark.createDataFrame([(1, i + 1, v) for i, v in enumerate([10, 11, 12, 13, 14, 15, 16, 99])] + [(2, 1, 99)], "question_id int, rank int, vec_id long")
    rows = retrieval.context_chunks(hits, places, docs).orderBy("rank").collect()
    assert [(r["rank"], r["start"], r["end"]) for r in rows] == [(1, 0, 700), (2, 0, 700), (3, 600, 1300), (4, 2400, 3000), (5, 0, 5)]
    assert all(r.chunk_text == (text if r.doc_id == 1 else "short")[r["start"] : r["end"]] and len(r.chunk_text) <= 700 for r in rows)
    joined = dict(map(tuple, retrieval.chunk_contexts(hits, places, docs).collect()))
    assert joined == {1: "\n\n".join(r.chunk_text for r in rows), 2: ""}


def test_single_question_is_an_ordered_top_k(spark, vectors):
    question = vectors.filter("vec_id = 5").first().embedding
    rows = retrieval.nearest_to(vectors, question, 3).collect()
    assert len(rows) == 3 and rows[0].vec_id == 5 and rows[0].distance == 0.0
    plan = retrieval.nearest_to(vectors, question, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_contexts_and_sources(spark):
    hits = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (1, 3, 12), (2, 1, 12), (2, 2, 99)], "question_id int, rank int, vec_id long")
    texts = spark.createDataFrame([(10, "ten"), (11, "eleven"), (12, "twelve")], "vec_id long, chunk_text string")
    assert dict(map(tuple, retrieval.contexts(hits, texts).collect())) == {1: "ten\n\neleven\n\ntwelve", 2: "twelve"}
    sources = spark.createDataFrame([(10, "A", "u1"), (11, "B", "u1"), (12, None, "u2")], "vec_id long, title string, source string")
    assert [tuple(r) for r in retrieval.source_list(hits, sources).collect()] == [
        (1, 1, "A", "u1"),
        (1, 3, "No title", "u2"),
        (2, 1, "No title", "u2"),
        (2, 2, "No title", "No link"),
    ]


def test_located_chunks_hold_their_text_and_the_law_sees_faults(spark):
    texts = ["word " * 500, "x" * 2000, "para one\n\n" + "line\n" * 300, "\u3000 a \x1c", " \n ", None, "", "tab\t" * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    chunks = chunking.split_documents(docs, "text", located=True).cache()
    rows = chunks.collect()
    assert all(texts[r.doc_id][r["start"] : r["end"]] == r.chunk_text for r in rows)
    law = chunking.chunk_coverage(docs, chunks, "doc_id", "text").collect()
    assert {r.doc_id for r in law} == {0, 1, 2, 3, 7} and all(all(list(r)[1:]) for r in law)
    faults = {
        "whole": chunks.where("not (doc_id = 0 and chunk_no = 1)"),
        "holds_its_text": chunks.withColumn("chunk_text", F.when(F.col("doc_id") == 0, F.reverse("chunk_text")).otherwise(F.col("chunk_text"))),
        "within_overlap": chunks.withColumn("start", F.when(F.col("doc_id") == 0, F.greatest(F.lit(0), F.col("start") - 200)).otherwise(F.col("start"))),
    }
    for name, wrong in faults.items():
        verdicts = {r.doc_id: r[name] for r in chunking.chunk_coverage(docs, wrong, "doc_id", "text").collect()}
        assert verdicts[0] is False and verdicts[2] is True
