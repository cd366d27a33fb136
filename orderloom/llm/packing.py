"""Packing of tokenised documents into sequences, shortest pack first over the length histogram.

1. Tokenise every text (Arrow batches), append the end id and cut: full sequences, and one
   rest shorter than a sequence. Each rest gets its rank among the rests of its length in
   its task. The pieces are stored once.
2. The histogram of rest lengths has fewer entries than a sequence has tokens, so the plan
   is made on the driver: lengths are placed longest first, each time into the packs with
   the most room left, which only updates the counts of packing patterns.
3. Patterns are handed back by rank: the rests of a length, in the order of task and rank,
   fill the slots that the patterns have for this length. The slot table has at most a
   few entries per length; tasks look ranks up in it.

No row moves in steps 1 to 3 but the counts per task and length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import prepare, read_table, slices, stored, text_of
from .tokens import END_ID, TOKENIZER_FILE, Segments

SEQUENCE = 1024
#: Bytes of text that are tokenised at a time.
TEXT_BYTES = 1 << 22
_BASE = 1 << 40


def _cut(counts: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of ``counts`` tokens: text, start and length of every piece."""
    pieces = -(-counts // sequence)
    text = np.repeat(np.arange(len(counts)), pieces)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = nth * sequence
    return text, start, np.minimum(sequence, counts[text] - start)


def _ranked(length: np.ndarray, used: np.ndarray) -> np.ndarray:
    """How many pieces of its length each piece comes after; ``used`` goes on counting."""
    order = np.argsort(length, kind="stable")
    new = np.bincount(length, minlength=len(used))
    rank = np.empty(len(length), np.int64)
    rank[order] = used[length[order]] + np.arange(len(length)) - np.repeat(np.cumsum(new) - new, new)
    used += new
    return rank


def _pieces(docs: DataFrame, id_col: str, text_col: str, sequence: int, tokenizer_file: str, with_ids: bool) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("_text"))

    def cut(batches):
        segments = Segments.shared(tokenizer_file)
        part = TaskContext.get().partitionId()
        used = np.zeros(sequence + 1, np.int64)  # pieces of each length so far
        for batch in batches:
            for texts in slices(batch, pc.binary_length(batch["_text"]), TEXT_BYTES):
                for row, counts, ids in segments.encode(texts["_text"]):
                    ids = np.insert(ids, np.cumsum(counts), END_ID)
                    text, start, length = _cut(counts + 1, sequence)
                    # Pieces stand on end, as the texts do.
                    ends = 4 * np.concatenate([[0], np.cumsum(length)])
                    data = memoryview(ids.tobytes())
                    crc = [zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:])]
                    columns = {"doc_id": texts["doc_id"].take(pa.array(row[text]))}
                    numbers = {"start": start, "length": length, "doc_tokens": counts[text] + 1}
                    numbers |= {"ids_crc32": np.array(crc, np.int64), "rank": _ranked(length, used), "part": np.full(len(text), part)}
                    columns |= {name: pa.array(values, pa.int64()) for name, values in numbers.items()}
                    if with_ids:
                        offsets = pa.py_buffer(ends.astype(np.int32))
                        columns["ids"] = pa.Array.from_buffers(pa.binary(), len(text), [None, offsets, pa.py_buffer(data)])
                    yield pa.record_batch(columns)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, doc_tokens long, ids_crc32 long, rank long, part long"
    return rows.mapInArrow(cut, f"{schema}, ids binary" if with_ids else schema)


def pack_patterns(histogram: dict[int, int], sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in a sequence, longest first) and how many sequences follow each.

    Packs are kept by room left. The next length, longest first, goes into the packs with
    the most room; if they are more than needed, they are split into two counts, and if
    there are none with enough room, new packs are opened.
    """
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, pattern: tuple[int, ...], count: int) -> None:
        if not by_room[room]:
            bisect.insort(rooms, room)
        by_room[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if rooms and rooms[-1] >= length:
                room = rooms[-1]
                pattern, count = by_room[room].pop()
                if not by_room[room]:
                    rooms.pop()
            else:
                room, pattern = sequence, ()
                # As many new packs as take the rest of this length, several in each.
                fit = sequence // length
                count = max(1, left // fit) if left >= fit else 1
                take = min(fit, left)
                put(sequence - take * length, (length,) * take, count)
                left -= take * count
                continue
            take = min(count, left)
            if take < count:
                put(room, pattern, count - take)
            put(room - length, (*pattern, length), take)
            left -= take
    return [entry for room in sorted(by_room) for entry in by_room[room]]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each slot of a pattern: the length and first rank it takes, first sequence, offset."""
    used: dict[int, int] = defaultdict(int)
    found, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            found.append((length * _BASE + used[length], sequence, offset))
            used[length] += count
            offset += length
        sequence += count
    found.sort()
    keys, sequences, offsets = (np.array(c, np.int64) for c in zip(*found)) if found else [np.empty(0, np.int64)] * 3
    return {"key": keys, "sequence": sequences, "offset": offsets}


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    tokenizer_file: str = TOKENIZER_FILE,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids_crc32, ids, sequence_id, offset``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers, and
    ``ids_crc32`` their check sum; where the check sum is enough, ``with_ids=False`` keeps the
    ids from being stored. A document ends with id 0; a null or empty text is that id alone.
    The text of a special token becomes that token, as the tokenizer file has it.
    ``sequence_id`` counts from 0 without gaps, ``offset`` from 0 without gaps in each
    sequence. A row without an id or with a repeated id is packed like any other. An empty
    table gives an empty result; other columns are ignored.
    """
    spark = prepare(docs.sparkSession)
    pieces = stored(_pieces(docs, id_col, text_col, sequence, tokenizer_file, with_ids), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(pack_patterns(histogram, sequence)))

    def place(batches):
        table = slots.value
        for batch in batches:
            key = batch["length"].to_numpy() * _BASE + batch["rank"].to_numpy() + batch["before"].to_numpy()
            at = np.searchsorted(table["key"], key, side="right") - 1
            columns = {f.name: batch[f.name] for f in batch.schema if f.name not in ("rank", "before")}
            columns["sequence_id"] = pa.array(table["sequence"][at] + key - table["key"][at])
            yield pa.record_batch(columns | {"offset": pa.array(table["offset"][at])})

    own = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in own)
    ranked = pieces.join(counts.select("part", "length", "before"), ["part", "length"])
    return ranked.select(*own, "rank", "before").mapInArrow(place, f"{schema}, sequence_id long, offset long")


def op2_packing(spark, sf_dir: str) -> DataFrame:
    packed = pack(read_table(spark, sf_dir, "documents"), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
