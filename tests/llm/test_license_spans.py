"""Priority and containment of license detections against every pair of matches."""

import random
import re

from lakeworks.llm import licenses
from lakeworks.llm.license_rules import rules

PIECES = [
    "Licensed under the Apache License, Version 2.0", "www.apache.org/licenses/LICENSE-2.0", "MIT License", "the MIT license (MIT)",
    "GNU General Public License version 3 or any later version", "GNU Lesser General Public License v2.1", "GPL-2.0-only", "gpl v3",
    "cc by-nc-sa 4.0", "Creative Commons Attribution 4.0 International", "CC BY", "cc0 1.0", "All rights reserved.", "Copyright (c) 2020 by Acme",
    "Permission is hereby granted, free of charge,", "BSD 3-Clause", "Redistribution and use in source and binary forms",
    "provided as is without warranty of any kind", "public domain", "Mozilla Public License 2.0", "some plain words", "x", "license", "apache", "2.0",
]


def brute(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.sub(licenses.SEPARATORS, " ", lower).strip(" ")
    norm = f" {words} " if words else " "
    spans = [
        (m.start(), m.end(), priority, no, label)
        for no, (label, priority, keyword, regex) in enumerate(rules())
        if keyword in norm
        for m in re.finditer(f"(?<= )(?:{regex})(?= )", norm)
    ]

    def beaten(a, b):
        return b[0] <= a[0] and b[1] >= a[1] and (b[2], b[1] - b[0], -b[3]) > (a[2], a[1] - a[0], -a[3])

    return sorted(a for a in spans if not any(beaten(a, b) for b in spans))


def test_detections_equal_every_pair_compared(spark, monkeypatch):
    monkeypatch.setattr(licenses, "SLICE", 8)  # texts of many slices
    rng = random.Random(5)
    texts = [" ".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(60)] + ["", None, "MIT License " * 300]
    docs = spark.createDataFrame([(i, t, "clash", 7) for i, t in enumerate(texts)], "doc_id long, text string, labels string, _found int")
    got = {r["doc_id"]: [tuple(d) for d in r["detections"]] for r in licenses.scan(docs).collect()}
    assert {i: sorted(v) for i, v in got.items()} == {i: brute(t) for i, t in enumerate(texts)}
    assert sum(map(len, got.values())) > 500
    assert licenses.scan(docs.limit(0)).collect() == []


def test_many_repeated_license_sentences(spark):
    sentence = "Licensed under the Apache License, Version 2.0, the MIT License and GPL-3.0 here. "
    docs = spark.createDataFrame([(1, sentence * 3000)], "doc_id long, text string")
    row = licenses.scan(docs).collect()[0]
    once = licenses.scan(spark.createDataFrame([(1, sentence)], docs.schema)).collect()[0]
    assert len(row["detections"]) == 3000 * len(once["detections"]) and row["labels"] == once["labels"]
