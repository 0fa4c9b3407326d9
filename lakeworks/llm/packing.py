"""Minimum bin slack packing of token pieces into windows of fixed capacity.

Every document is tokenised once and cut into pieces of the capacity plus one remainder. Only how many pieces there
are of each length (at most ``capacity`` numbers) goes to the driver. There a bitset subset-sum over the remaining
lengths finds, for the longest length left, the multiset that fills a window closest to capacity; it is read back from
the stored bitsets and used as often as the counts allow. Pieces then find their window by their rank in their length.

Defined results: a null or empty text is the end id alone; repeated rows are separate documents; an empty table gives
an empty result; a text of any length is cut, never dropped; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.llm.common import rank_buckets, ranked, slices, stored

CAPACITY = 2048
END_ID = 1
#: The split pattern and the special token of the byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"
CACHED_WORDS = 300_000

_encoders: dict[str, Callable[[str], bytes]] = {}


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Words(dict):
    """Ids of a word as little-endian bytes, encoded when first asked for; emptied when it grows too large."""

    def __init__(self, encode: Callable[[str], list[int]], prefix: str) -> None:
        super().__init__()
        self.encode, self.prefix = encode, prefix

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        ids = np.asarray(self.encode(self.prefix + word), dtype="<u4").tobytes()
        if len(word) < 64:
            self[word] = ids
        return ids


def encoder(path: str) -> Callable[[str], bytes]:
    """Text to ids (little-endian uint32 bytes) of the tokenizer file; one per worker process.

    A single blank or line end between two other characters is always a border of the split, so such texts are
    encoded word by word from a cache. Texts with the special token go through the tokenizers library as they are.
    """
    if path not in _encoders:
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in word): i for word, i in vocabulary.items() if word != SPECIAL}
        plain = tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        whole = Tokenizer.from_file(path)
        first, later = _Words(plain, ""), _Words(plain, " ")
        line_end = np.asarray(plain("\n"), dtype="<u4").tobytes()
        runs = re.compile(r"[\s\x1c-\x1f]{2}")

        def line(text: str) -> bytes:
            words = text.split(" ")
            return first[words[0]] + b"".join(map(later.__getitem__, words[1:]))

        def encode(text: str) -> bytes:
            if SPECIAL in text:
                return np.asarray(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
            if not text or text[0].isspace() or text[-1].isspace() or runs.search(text):
                return np.asarray(plain(text), dtype="<u4").tobytes()
            return line_end.join(map(line, text.split("\n")))

        _encoders[path] = encode
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text",
           with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece; with the ids themselves if asked for."""
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in slices(batches):
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(body or "") + end
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at : at + 4 * capacity]
                    row = (name, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, part)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            columns = [pa.array(out[0], batch.schema.field(0).type), *[pa.array(x, pa.int64()) for x in out[1:5]]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype("i4") for x in out[5]], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    extra = ", ids array<int>" if with_ids else ""
    return rows.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long{extra}")


def _fullest(counts: np.ndarray, longest: int, capacity: int) -> dict[int, int]:
    """The multiset of lengths with one ``longest`` whose sum comes closest to capacity, as length -> times."""
    room = capacity - longest
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    lengths = np.flatnonzero(counts[: room + 1])[::-1]
    for length in lengths.tolist():
        left = min(int(counts[length]) - (length == longest), room // length)
        times = 1
        while left > 0:
            take = min(times, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & mask
            left -= take
            times *= 2
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    chosen = {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            best -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """How the pieces of each length are dealt to windows: runs of ranks, by (length, first rank).

    ``length, rank``: where a run begins; ``times``: pieces of this length in one window; ``sequence``: the first
    window of the run; ``offset``: where the length begins in the window.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros_like(left)
    runs, sequence, longest = [], 0, capacity
    while True:
        while longest > 0 and left[longest] == 0:
            longest -= 1
        if longest == 0:
            break
        pattern = _fullest(left, longest, capacity)
        repeats = min(int(left[length]) // times for length, times in pattern.items())
        offset = 0
        for length, times in pattern.items():
            runs.append((length, int(used[length]), times, sequence, offset))
            used[length] += repeats * times
            left[length] -= repeats * times
            offset += length * times
        sequence += repeats
    columns = np.asarray(sorted(runs), dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "times", "sequence", "offset"), columns, strict=True))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (as from ``pieces``). ``cut`` is read twice: store it first."""
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_windows(counts, capacity)
    buckets = rank_buckets(spark, sum(counts.values()))
    draw = F.xxhash64("doc_id", "start", "ids_crc32")
    order = [F.col(c) for c in ("doc_id", "start", "ids_crc32")]
    spread = ranked(cut, ["length"], F.pmod(draw, F.lit(buckets)), order, "_rank").drop("_rank_total")
    run_key = plan["length"] << 45 | plan["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            run = np.searchsorted(run_key, length << 45 | rank, side="right") - 1
            nth = rank - plan["rank"][run]
            window = plan["sequence"][run] + nth // plan["times"][run]
            offset = plan["offset"][run] + nth % plan["times"][run] * length
            kept = [batch.column(c) for c in batch.schema.names if c != "_rank"]
            names = [c for c in batch.schema.names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(window), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spread.schema if f.name != "_rank")
    return spread.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    return pack(stored(pieces(docs, tokenizer, capacity, with_ids=with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The windows themselves: sequence_id and its ids in order; a group is at most one window."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
