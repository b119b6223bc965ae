"""Token ids in shards of bit-packed blocks.

A shard holds documents in ascending order of ``doc_id``::

    "TIDEBITS"                         8 bytes
    blocks                             each of BLOCK ids (the last may be shorter), `width` bits an id, least significant bit
                                       first, padded to whole bytes
    block offsets                      u64 a block: where it begins in the file
    document ids                       i64 a document, the smallest i64 for null
    document starts                    u64 a document and one more: ids before it in the shard
    trailer                            u32 width, u32 BLOCK, u64 blocks, u64 documents, u64 position of the block offsets, "TIDEBITS"

``width`` is the least number of bits for the vocabulary. Every id of a block sits at a fixed bit, so a block is unpacked with a few
numpy operations, and the ids of any document are read from its blocks alone.

Tasks write shards under names of their own and hand on one row for each shard; that list is written by Spark, so shards of repeated
or lost tasks are never read. Shards are ordered by range of ``doc_id``.

Defined results: null and empty texts hold the end id only. Null ids come first. Repeated ids are kept, ordered by the hash of
their texts. Other columns are ignored, whatever their names. An empty table gives no documents.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.encoding import encode_all, encoder
from tidewell.llm.files import create, locate, new_folder
from tidewell.session import materialize

MAGIC = b"TIDEBITS"
BLOCK = 1 << 15
TRAILER = struct.Struct("<IIQQQ8s")
NO_ID = -(1 << 63)


def width_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids[:, None].astype(np.uint64) >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def unpack_bits(data: bytes, count: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little").reshape(count, width)
    return (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


class ShardWriter:
    def __init__(self, stream, width: int) -> None:
        self.stream, self.width = stream, width
        self.position, self.ids = len(MAGIC), 0
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.blocks: list[int] = []
        self.documents: list[int] = []
        self.starts: list[int] = [0]
        stream.write(MAGIC)

    def add(self, document: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.width:
            raise ValueError(f"an id does not fit in {self.width} bits")
        self.documents.append(NO_ID if document is None else document)
        self.ids += len(ids)
        self.starts.append(self.ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            self._flush(self.n_waiting // BLOCK * BLOCK)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting)
        for at in range(0, count, BLOCK):
            packed = pack_bits(ids[at : min(at + BLOCK, count)], self.width)
            self.blocks.append(self.position)
            self.stream.write(packed)
            self.position += len(packed)
        self.waiting, self.n_waiting = [ids[count:]], len(ids) - count

    def close(self) -> None:
        if self.n_waiting:
            self._flush(self.n_waiting)
        for values, kind in ((self.blocks, "<u8"), (self.documents, "<i8"), (self.starts, "<u8")):
            self.stream.write(np.array(values, kind).tobytes())
        self.stream.write(TRAILER.pack(self.width, BLOCK, len(self.blocks), len(self.documents), self.position, MAGIC))
        self.stream.close()


class ShardReader:
    """Documents of one shard, each read from its own blocks."""

    def __init__(self, uri: str) -> None:
        system, path = locate(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        self.width, self.block, blocks, documents, position, magic = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"not a shard of token ids: {uri}")
        tables = self.file.read_at(size - TRAILER.size - position, position)
        self.offsets = np.append(np.frombuffer(tables, "<u8", blocks), position).astype(np.int64)
        self.documents = np.frombuffer(tables, "<i8", documents, 8 * blocks)
        self.starts = np.frombuffer(tables, "<u8", documents + 1, 8 * (blocks + documents)).astype(np.int64)
        self._held: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _ids_of_block(self, number: int) -> np.ndarray:
        if self._held[0] != number:
            count = min(self.block, int(self.starts[-1]) - number * self.block)
            data = self.file.read_at(int(self.offsets[number + 1] - self.offsets[number]), int(self.offsets[number]))
            self._held = (number, unpack_bits(data, count, self.width))
        return self._held[1]

    def ids(self, place: int) -> np.ndarray:
        """Ids of the document at ``place`` in the shard."""
        start, end = int(self.starts[place]), int(self.starts[place + 1])
        parts = []
        for number in range(start // self.block, -(-end // self.block)):
            base = number * self.block
            parts.append(self._ids_of_block(number)[max(start - base, 0) : end - base])
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")


MANIFEST = "shard long, path string, documents long, ids long"


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Encode and write all documents; one row per shard: ``shard`` (ascending with ``doc_id``), ``path``, ``documents``, ``ids``."""
    folder = new_folder(docs.sparkSession, "tokens")
    end = np.array([end_id], "<u4")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = path = None
        for batch in batches:
            if batch.num_rows and writer is None:
                path, stream = create(folder, f"shard-{TaskContext.get().partitionId():06d}")
                writer = ShardWriter(stream, width_for(max(encoder(tokenizer).vocabulary_size, end_id + 1)))
            for document, ids in zip(batch.column("doc_id").to_pylist(), encode_all(tokenizer, batch.column("text")), strict=True):
                writer.add(document, np.append(ids, end))
        if writer:
            writer.close()
            row = [[TaskContext.get().partitionId()], [path], [len(writer.documents)], [writer.ids]]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], ["shard", "path", "documents", "ids"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    sorted_docs = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(sorted_docs.mapInArrow(task, MANIFEST), "manifest")


DOCUMENTS = "doc_id long, start long, ids binary"


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Each document of the shards: ``doc_id``, ``start`` (ids of all documents before it) and ``ids`` (little-endian 32-bit integers)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one narrow row per shard
    based = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                reader = ShardReader(uri)
                for at in range(0, len(reader.documents), 512):
                    places = range(at, min(at + 512, len(reader.documents)))
                    ids = [None if reader.documents[x] == NO_ID else int(reader.documents[x]) for x in places]
                    starts = base + reader.starts[at : at + len(places)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(starts), pa.array([reader.ids(x).tobytes() for x in places], pa.binary())],
                        ["doc_id", "start", "ids"],
                    )

    shards = max(1, manifest.count())
    return based.select("shard", "path", "base").repartitionByRange(shards, "shard").mapInArrow(task, DOCUMENTS)
