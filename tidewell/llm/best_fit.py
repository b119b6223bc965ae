"""Best-fit packing of token sequences, planned on the histogram of lengths.

The plan needs only how many pieces there are of each length (at most ``capacity`` numbers): lengths are placed in descending
order, each into the fullest open sequences that still take it, whole groups of equally filled sequences at a time. Every
piece then finds its slot by its rank among the pieces of its length. Ranks come from groups of about :data:`RANK_GROUP` rows, so a
length that a third of all pieces share is spread over many tasks.

Defined results: null and empty texts are one piece that holds the end id only; repeated rows and equal or null ids are packed
row by row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.encoding import encode_all
from tidewell.session import materialize

CAPACITY = 2048
RANK_GROUP = 16_384
FLUSH_BYTES = 1 << 23

PIECES = "doc_id long, piece int, start long, length int, ids binary"


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Token ids (little-endian 32-bit integers) of each document with its end id, in pieces of at most ``capacity``.

    Only longer documents are cut; their first piece takes the remainder.
    """
    end = np.array([end_id], "<u4").tobytes()

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
        columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc, own in zip(batch.column("doc_id").to_pylist(), encode_all(tokenizer, batch.column("text")), strict=True):
                ids = own.tobytes() + end
                n = len(ids) // 4
                at, piece = 0, 0
                while at < n:
                    length = (n - 1) % capacity + 1 if at == 0 else capacity
                    rows.append((doc, piece, at, length, ids[4 * at : 4 * (at + length)]))
                    at, piece = at + length, piece + 1
                held += len(ids)
                if held > FLUSH_BYTES:
                    yield as_batch(rows)
                    rows, held = [], 0
            if rows:
                yield as_batch(rows)

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(task, PIECES)


@dataclass
class Slots:
    """Row i: pieces of ``length`` from rank ``rank`` on fill ``each`` places in every sequence from ``sequence`` on, from ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def take(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece, by its length and its rank among that length."""
        at = np.searchsorted(self.length * (1 << 48) + self.rank, length.astype(np.int64) * (1 << 48) + rank, "right") - 1
        place = rank - self.rank[at]
        return self.sequence[at] + place // self.each[at], self.offset[at] + place % self.each[at] * length


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Slots:
    """Best fit, longest first, over counts. Sequences that are equally full are kept as runs of numbers."""
    rooms: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}
    slots: list[tuple[int, int, int, int, int]] = []
    used = 0

    def put_back(room: int, first: int, count: int) -> None:
        if count and room:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, count))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count = runs[room].pop()
                if not runs[room]:
                    del runs[room], rooms[at]
            else:
                room, first, count = capacity, used, -(-left // (capacity // length))
                used += count
            each = room // length
            full = min(count, left // each)
            if full:
                slots.append((length, rank, each, first, capacity - room))
                put_back(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            rest = min(left, each) if full < count else 0
            if rest:
                slots.append((length, rank, rest, first + full, capacity - room))
                put_back(room - rest * length, first + full, 1)
                rank, left = rank + rest, left - rest
            put_back(room, first + full + bool(rest), count - full - bool(rest))
    columns = [np.array(x, np.int64) for x in zip(*slots, strict=True)] if slots else [np.zeros(0, np.int64)] * 5
    order = np.lexsort((columns[1], columns[0]))
    return Slots(*(x[order] for x in columns), used)


def with_rank(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """``pieces`` with ``rank``, from 0 within each length. ``counts`` has a row for each length, ``capacity`` at most."""
    groups = counts.select("length", F.ceil(F.col("count") / F.lit(RANK_GROUP)).cast("long").alias("groups"))
    salted = pieces.join(F.broadcast(groups), "length").withColumn("salt", F.pmod(F.xxhash64("piece_key"), "groups"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("size"))
    bases = sizes.select("length", "salt", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("piece_key")) - 1
    ranked = salted.withColumn("inside", inside).join(bases, ["length", "salt"])
    return ranked.select("piece_key", "length", (F.col("base") + F.col("inside")).alias("rank"))


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``piece_key``, ``sequence_id``, ``offset`` for each row of ``pieces`` (piece_key long, unique; length int)."""
    narrow = pieces.select("piece_key", "length")
    counts = narrow.groupBy("length").count()
    slots = plan({row["length"]: row["count"] for row in counts.collect()}, capacity)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.take(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("piece_key"), pa.array(sequence), pa.array(offset)], ["piece_key", "sequence_id", "offset"])

    return with_rank(narrow, counts).mapInArrow(task, "piece_key long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """Pieces with their ids and a ``piece_key``, written once, and the place of each."""
    pieces = pieces_of(docs, tokenizer, end_id, capacity).withColumn("piece_key", F.monotonically_increasing_id())
    pieces = materialize(pieces, "pieces", compression="zstd")
    return pieces, place(pieces, capacity)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, ``length`` and ``ids`` (binary); a sequence has at most ``capacity`` ids."""
    parts = pieces.join(placed, "piece_key").groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    joined = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return parts.select("sequence_id", "length", joined.alias("ids"))
