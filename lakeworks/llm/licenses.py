"""License scan: ordered signature rules over whole texts, in built-in expressions only.

A text is lower-cased (A-Z) and reduced to its words with single blanks. A few plain strings decide whether it can hold
any license wording at all; then each rule's keyword decides whether its regex runs; the matches of all rules are laid
out as character intervals, and an interval is dropped when another one contains it and has the higher priority (ties:
the longer, then the earlier rule). What is left gives labels and score. Three base phrases are counted on top.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows give repeated results; an
empty table gives an empty result; further columns are ignored. Texts are read whole, however long: detections are sorted
by place and swept once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.license_rules import rules

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: A text with none of these can match no rule: every keyword contains one of them (checked below).
GATES = (
    "licen", "copyright", "copyleft", "rights reserved", "public domain", "creative", "cc by", "cc0", "gpl", "gnu",
    "apache", "mit no", "bsd", "mpl", "permission", "warrant", "as is basis", "free software", "software is provided", "cecill",
    "mulan", "wtfpl", "openrail", "redistribution", "proprietary", "unauthori", "reproduced", "endorse", "noncommercial",
    "use only", "purposes", "trade", "patent", "terms of", "fair use", "unencumbered", "open data commons", "zlib",
    "libpng", "ncsa", "python", "bitstream", "expat", "spdx", "common development", "common public", "community data", "european union",
)
BASE_SCORE = 0.3
#: Items after which a growing array of spans is closed; only the cost depends on it.
SLICE = 256
_SPAN = "struct<s:int,e:int,priority:int,no:int,label:string>"


def _rules_column() -> Column:
    table = []
    for no, (label, priority, keyword, regex) in enumerate(rules()):
        if not any(gate in keyword for gate in GATES):
            raise ValueError(f"no gate covers the keyword {keyword!r}")
        whole_words = f"(?<= )(?:{regex})(?= )"
        fields = {"no": no, "label": label, "priority": priority, "keyword": keyword, "regex": whole_words}
        table.append(F.struct(*[F.lit(v).alias(k) for k, v in fields.items()]))
    return F.array(*table)


def _spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def _walk(items: Column, state: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column, Column]]) -> Column:
    """Spans that ``step`` emits along an array with a running state.

    ``step(state, item)`` gives the new state, whether to emit, and a span. An array is copied whenever it grows, so
    spans are gathered in slices of ``SLICE`` items and the slices joined at the end.
    """
    no_spans = F.array().cast(f"array<{_SPAN}>")

    def one(acc: Column, item: Column) -> Column:
        after, emits, span = step(acc["state"], item)
        out = F.when(emits, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(after.cast(kind).alias("state"), out.alias("out"))

    def sliced(acc: Column, all_items: Column, start: Column) -> Column:
        begin = F.struct(acc["state"].alias("state"), no_spans.alias("out"))
        done = F.aggregate(F.slice(all_items, start, F.lit(SLICE)), begin, one)
        return _let(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["parts"], F.array(d["out"])).alias("parts")))

    def whole(all_items: Column) -> Column:
        starts = F.when(F.size(all_items) > 0, F.sequence(F.lit(1), F.size(all_items), F.lit(SLICE))).otherwise(F.array().cast("array<int>"))
        zero = F.struct(state.cast(kind).alias("state"), F.array().cast(f"array<array<{_SPAN}>>").alias("parts"))
        return F.aggregate(starts, zero, lambda acc, at: sliced(acc, all_items, at), lambda acc: F.flatten(acc["parts"]))

    return _let(items, whole)


def _intervals(norm: Column, rule: Column) -> Column:
    """All matches of one rule as spans: lengths of matches and of what stands between, summed up."""
    between = F.split(norm, rule["regex"])
    matches = F.regexp_extract_all(norm, rule["regex"], F.lit(0))
    lengths = F.zip_with(between, matches, lambda a, b: F.struct(F.length(a).alias("a"), F.length(b).alias("b")))

    def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
        start = at + x["a"]
        end = start + F.coalesce(x["b"], F.lit(0))
        span = F.struct(
            start.alias("s"), end.alias("e"), rule["priority"].alias("priority"), rule["no"].alias("no"), rule["label"].alias("label")
        ).cast(_SPAN)
        return end, x["b"].isNotNull(), span

    return _walk(lengths, F.lit(0), "int", step)


def _uncontained(spans: Column, levels: list[int]) -> Column:
    """The spans that no other one of higher priority (ties: longer, then earlier rule) contains, by place.

    Sorted by start, falling end, falling priority and rule, whatever suppresses a span stands before it, and a span
    before it suppresses it when it reaches as far and has at least its priority. So one sweep suffices, with the
    furthest end so far of each priority and those above it.
    """
    place = lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), (-x["priority"]).alias("priority"), x["no"].alias("no"), x["label"].alias("label"))
    in_order = F.array_sort(F.transform(spans, place))
    known = F.array(*[F.lit(p) for p in levels])

    def step(best: Column, x: Column) -> tuple[Column, Column, Column]:
        level, end = F.array_position(known, -x["priority"]).cast("int"), -x["e"]
        reach = F.transform(best, lambda furthest, i: F.when(i < level, F.greatest(furthest, end)).otherwise(furthest))
        span = F.struct(
            x["s"].alias("s"), end.alias("e"), (-x["priority"]).alias("priority"), x["no"].alias("no"), x["label"].alias("label")
        ).cast(_SPAN)
        return reach, best[level - 1] < end, span

    return _walk(in_order, F.array(*[F.lit(-1) for _ in levels]), "array<int>", step)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, word and base counts, labels, score, and detections (spans in the normalised text)."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    words = F.trim(F.regexp_replace(lower, SEPARATORS, " "))
    rows = docs.select(F.col(key).alias("doc_id"), words.alias("_words"))
    rows = rows.withColumn(
        "_norm", F.when(F.col("_words") == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), "_words", F.lit(" ")))
    ).drop("_words")
    norm = F.col("_norm")
    rows = rows.withColumns(
        {"n_words": (_spaces(norm) - 1).cast("long"), "_gated": reduce(Column.__or__, [F.contains(norm, F.lit(g)) for g in GATES])}
    )
    starts, ends, counts, names = [], [], [], []
    for phrase, label in BASE.items():
        around, length = f" {phrase} ", len(phrase.split())
        there = F.contains(norm, F.lit(around))
        starts.append(F.when(there, _spaces(F.substring_index(norm, around, 1)).cast("long")))
        after = _spaces(F.substring_index(norm, around, -1)).cast("long")
        ends.append(F.when(there, F.col("n_words") - after - length))
        places = F.regexp_count(norm, F.lit(f" {phrase}(?= )")).cast("long")
        counts.append(F.when(there, places).otherwise(0))
        names.append(F.when(there, F.lit(label)))
    hits = F.filter(_rules_column(), lambda r: F.contains(norm, r["keyword"]))
    found = F.flatten(F.transform(hits, lambda r: _intervals(norm, r)))
    rows = rows.withColumns(
        {
            "n_base": reduce(Column.__add__, counts),
            "first_word": F.least(*starts),
            "last_word": F.greatest(*ends),
            "_base": F.array_compact(F.array(*names)),
            "_found": F.when(F.col("_gated"), found).otherwise(F.array().cast(f"array<{_SPAN}>")),
        }
    ).drop("_norm", "_gated")
    levels = sorted({priority for _, priority, _, _ in rules()})
    rows = rows.withColumn("detections", _uncontained(F.col("_found"), levels)).drop("_found")
    strongest = F.array_max(F.transform("detections", lambda d: d["priority"])) / 100
    base_score = F.when(F.col("n_base") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))
    joined = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    every = F.concat("_base", F.transform("detections", lambda d: d["label"]))
    return rows.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", joined(F.col("_base")).alias("base_labels"),
        joined(every).alias("labels"),
        F.greatest(F.coalesce(strongest, F.lit(0.0)), base_score).alias("score"), "detections",
    )
