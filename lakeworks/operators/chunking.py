"""Cutting document texts into overlapping chunks."""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Iterator, Sequence
from itertools import chain

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package: the helpers below travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_SIZE = 700
CHUNK_OVERLAP = 100

# Documents cut at a time, so that texts and chunks of a whole Arrow batch never stand in memory as Python objects.
SLICE_ROWS = 64

# Break points from coarse to fine; the empty one cuts between characters.
SEPARATORS = ["\n\n", "\n", " ", ""]


def fixed_chunks(
    docs: DataFrame, text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """Chunks of ``size`` characters, each starting ``size - overlap`` after the one before.

    A last piece that lies wholly inside its predecessor's overlap is not repeated. The text is cut by
    two passes of one pattern (the strides, and what follows each), so the work stays linear in its
    length; positions by ``substring`` would walk a long text once per chunk.
    """
    stride = size - overlap
    pattern = f"(?s)(.{{1,{stride}}})(?=(.{{0,{overlap}}}))"
    heads = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))
    tails = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(2))
    pieces = F.zip_with(heads, tails, lambda head, tail: F.concat(head, tail))
    new_part = F.filter(pieces, lambda piece, i: (i == 0) | (F.length(piece) > overlap))
    return docs.select(*[c for c in docs.columns if c != text], F.posexplode(new_part).alias("chunk_no", "chunk_text"))


def located_chunks(
    docs: DataFrame, text: str = "text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> DataFrame:
    """The fixed chunks with the characters ``start`` to ``end`` - 1 of the text they hold."""
    start = (F.col("chunk_no") * (size - overlap)).cast("long")
    chunks = fixed_chunks(docs, text, size, overlap).withColumn("start", start)
    return chunks.withColumn("end", F.col("start") + F.length("chunk_text"))


def _pieces(text: str, lo: int, hi: int, size: int, separators: Sequence[str]) -> Iterator[tuple[int, int] | None]:
    """Bounds of the pieces of ``text[lo:hi]``: cut at the coarsest separator it contains, a piece that is still too long at
    finer ones.

    A separator stays at the head of the piece it introduces, so the pieces join up to the text. ``None`` marks where a
    run of neighbours ends: a piece that is broken further is packed by itself. A stretch without any separator is one
    piece, whatever its length: it may be cut between any two characters.
    """
    at = next(i for i, sep in enumerate(separators) if text.find(sep, lo, hi) >= 0)
    sep, finer = separators[at], separators[at + 1 :]
    if not sep:
        yield lo, hi
        return
    start, cut = lo, text.find(sep, lo, hi)
    while start < hi:
        end = cut if cut >= 0 else hi
        if end - start < size or not finer:
            yield start, end
        else:
            yield None
            yield from _pieces(text, start, end, size, finer)
            yield None
        start, cut = end, text.find(sep, end + len(sep), hi) if end < hi else -1


def _trimmed(text: str, lo: int, hi: int) -> tuple[int, int] | None:
    """The bounds without surrounding white space, None if nothing is left."""
    chunk = text[lo:hi]
    body = chunk.lstrip()
    return (hi - len(body), hi - len(body) + len(body.rstrip())) if body else None


def recursive_spans(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Iterator[tuple[int, int]]:
    """Bounds of chunks of at most ``size`` characters, packed from consecutive pieces.

    A full chunk hands its last pieces, up to ``overlap`` characters, on to the next one. Chunks are
    stripped of surrounding white space and empty ones left out. A stretch without separators is cut in strides.
    """
    window: deque[tuple[int, int]] = deque()

    def settled() -> Iterator[tuple[int, int]]:
        span = _trimmed(text, window[0][0], window[-1][1]) if window else None
        if span:
            yield span

    for piece in chain(_pieces(text, 0, len(text), size, SEPARATORS), [None]):
        if piece is not None and piece[1] - piece[0] > size:
            yield from settled()
            window.clear()
            lo, hi = piece
            for start in range(lo, max(lo + 1, hi - overlap), size - overlap):
                span = _trimmed(text, start, min(start + size, hi))
                if span:
                    yield span
            continue
        if piece is not None and (not window or piece[1] - window[0][0] <= size):
            window.append(piece)
            continue
        yield from settled()
        if piece is None:
            window.clear()
            continue
        while window and (window[-1][1] - window[0][0] > overlap or piece[1] - window[0][0] > size):
            window.popleft()
        window.append(piece)


def recursive_chunks(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Iterator[str]:
    """The texts of the recursive chunks."""
    for lo, hi in recursive_spans(text, size, overlap):
        yield text[lo:hi]


def split_documents(
    docs: DataFrame, text: str = "page_content", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, located: bool = False
) -> DataFrame:
    """One row per recursive chunk; every other column is carried to each of its chunks.

    ``located`` adds the characters ``start`` to ``end`` - 1 of the text that the chunk holds. The packing keeps state along
    a text, which no built-in expression does, so this is the one stage that runs in Python; it streams Arrow batches a few
    rows at a time, without a shuffle. It only finds the bounds; texts are cut from them row by row.
    """
    carried = [f for f in docs.schema.fields if f.name != text]
    numbers = [T.StructField(c, T.LongType()) for c in ("start", "end")] if located else []
    schema = T.StructType(
        [*carried, T.StructField("chunk_no", T.IntegerType()), *numbers, T.StructField("chunk_text", T.StringType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few = (batch.slice(at, SLICE_ROWS) for batch in batches for at in range(0, batch.num_rows, SLICE_ROWS))
        for batch in few:
            texts = batch.column(text).to_pylist()
            spans = [list(recursive_spans(t, size, overlap)) if t else [] for t in texts]
            rows = pa.array([row for row, own in enumerate(spans) for _ in own], pa.int64())
            if not len(rows):
                continue
            columns = {f.name: batch.column(f.name).take(rows) for f in carried}
            columns["chunk_no"] = pa.array([i for own in spans for i in range(len(own))], pa.int32())
            if located:
                columns["start"] = pa.array([lo for own in spans for lo, _ in own], pa.int64())
                columns["end"] = pa.array([hi for own in spans for _, hi in own], pa.int64())
            pieces = [t[lo:hi] for t, own in zip(texts, spans, strict=True) for lo, hi in own]
            columns["chunk_text"] = pa.array(pieces, batch.schema.field(text).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select(*[f.name for f in carried], text).mapInArrow(cut, schema)


def chunk_coverage(docs: DataFrame, chunks: DataFrame, key: str, text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Per document, whether its located chunks keep the law of the splitter.

    Chunks are in order and at most ``size`` long, hold the text they claim, overlap by ``overlap`` at most, and
    leave out nothing but white space. A row per document with any character that is not white space.
    """
    before = W.partitionBy(key).orderBy("chunk_no")
    whole = docs.select(key, F.col(text).alias("_text"))
    placed = chunks.withColumns({"_last": F.lag("end").over(before), "_next": F.lead("start").over(before)}).join(whole, key)
    held = F.col("_text").substr(F.col("start").cast("int") + 1, (F.col("end") - F.col("start")).cast("int")) == F.col("chunk_text")
    first = F.coalesce("_last", F.lit(0))
    gap = F.col("_text").substr(first.cast("int") + 1, F.greatest(F.lit(0), F.col("start") - first).cast("int"))
    tail = F.when(F.col("_next").isNull(), F.col("_text").substr(F.col("end").cast("int") + 1, F.length("_text"))).otherwise("")
    return placed.groupBy(key).agg(
        F.bool_and(F.length("chunk_text").between(1, size)).alias("within_size"),
        F.bool_and(held).alias("holds_its_text"),
        F.bool_and(F.coalesce(F.col("start") - F.col("_last") >= -overlap, F.lit(True))).alias("within_overlap"),
        F.bool_and(F.coalesce(F.col("_next") > F.col("start"), F.lit(True))).alias("in_order"),
        F.bool_and(~F.concat(gap, tail).rlike(r"(?U)[^\s\x1c-\x1f]")).alias("whole"),
    )
