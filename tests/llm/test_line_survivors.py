"""Telling lines that an earlier document holds survive only where they have moved alone."""

import random

import corpus_pipeline
from lakeworks.llm import linededup


def line(i):
    return f"this is the telling line number {i}"


def test_repeated_and_crossing_lines_of_earlier_documents_go(spark):
    rng = random.Random(13)
    docs = [
        (0, [line(1), line(2), "x", line(1), line(2)]),  # the earliest holder has the passage twice
        (1, ["own text of one", line(1), line(2)]), (2, ["own text of two", line(1), line(2), line(1), line(2), line(2)]),
        (3, [line(i) for i in (16, 15, 14, 13, 12, 11, 10)]),  # in another order
        (4, ["four", *map(line, range(10, 17))]), (5, ["five", *map(line, range(10, 17))]),
    ]
    for i in range(6, 120):
        docs.append((i, [line(rng.randrange(20, 60)) if rng.random() < 0.7 else f"own {i}" for _ in range(rng.randint(1, 12))]))
    rows = spark.createDataFrame([(i, "\n".join(x)) for i, x in docs], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split("\n") for r in linededup.dedup_lines(rows).collect()}
    assert got[1] == ["own text of one"] and got[2] == ["own text of two"] and got[5] == ["five"]
    assert len(got[4]) == 7  # one line aligns, the earliest holder has the others moved alone
    survivors = 0
    for i, x in docs[:4] + docs[6:]:
        for t in got[i]:
            earlier = [y for j, y in docs if j < i and t in y]
            if len(t.split()) >= linededup.MIN_WORDS and earlier:
                survivors += x.count(t) > 1 or earlier[0].count(t) > 1
        for t in x:  # what no earlier document holds stays
            assert t in got[i] or len(t.split()) < linededup.MIN_WORDS or any(t in y for j, y in docs if j < i)
    assert survivors == 0


def test_copies_of_short_lines_and_of_scripts_without_blanks_go(spark):
    verse = ["the moon is", "over the", "", "old harbour wall", "and sails"]
    chinese = ["\u6708\u4eae\u5728\u65e7\u6e2f\u53e3\u7684\u5899\u4e0a\u7167\u7740", "\u8239"]
    docs = [
        (1, verse), (2, ["of two", *verse, "end two"]), (3, chinese), (4, ["four", *chinese]),
        (5, ["a = compute_rare(x)", "}"]), (6, ["six", "a = compute_rare(x)", "other"]),
        *((i, [f"own words {i}", "return None # ok"]) for i in range(10, 30)), (40, ["}", "}", "}", "}"]), (41, ["}", "}", "}", "}"]),
    ]
    rows = spark.createDataFrame([(i, "\n".join(x)) for i, x in docs], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split("\n") for r in linededup.dedup_lines(rows).collect()}
    assert (got[2], got[4], got[6]) == (["of two", "end two"], ["four"], ["six", "other"])
    assert all(got[i] == x for i, x in docs if i not in (2, 4, 6))  # a frequent short line alone stays


def test_lines_left_by_many_holders_are_tried_with_each_of_them(spark):
    others = [line(i) for i in range(20)]
    docs = [(i, [*others[: 2 * i], "the telling line that has moved alone", *others[2 * i :]]) for i in range(8)]
    docs.append((8, docs[7][1]))  # what seven holders do not take goes by the eighth
    rows = spark.createDataFrame([(i, "\n".join(x)) for i, x in docs], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split("\n") for r in linededup.dedup_lines(rows).collect()}
    assert got[0] == docs[0][1] and got[8] == [""]
    assert all(got[i] == ["the telling line that has moved alone"] for i in range(1, 8))


def test_a_rare_short_line_left_by_one_holder_goes_by_the_next(spark):
    block = [line(i) for i in range(4)]
    docs = [(0, ["a = compute_rare(x)", "own", *block])] + [(i, [*block, f"own {i}", "a = compute_rare(x)", f"end {i}"]) for i in (1, 2)]
    rows = spark.createDataFrame([(i, "\n".join(x)) for i, x in docs], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split("\n") for r in linededup.dedup_lines(rows).collect()}
    assert got == {0: docs[0][1], 1: ["own 1", "a = compute_rare(x)", "end 1"], 2: ["own 2", "end 2"]}


def test_the_pipeline_drops_what_the_last_holder_takes(spark):
    others = [line(i) for i in range(20)]
    docs = [(i, "\n".join([*others[: 2 * i], "the telling line that has moved alone", *others[2 * i :]])) for i in range(8)]
    docs.append((8, docs[7][1]))
    rows = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"]: r["n_chars"] for r in corpus_pipeline.without_repeated_lines(spark, rows, "").collect()}
    alone = len("the telling line that has moved alone")
    assert kept == {0: len(docs[0][1]), **dict.fromkeys(range(1, 8), alone)}
