"""Language-model scoring: prediction by partial matching over bytes, trained on the corpus and spread over the cluster.

A text is its words in lower case (A to Z), one blank between them, and one end symbol. The model predicts each byte from the
:data:`ORDER` bytes before it. The context trie is a table for each order k: ``window`` (k context bytes and the symbol, as one number),
``n`` (how often), and for each context ``distinct`` (its symbols) and ``total`` (the sum of their counts). Orders below the longest
count by update exclusion: once for each longer context that met the symbol there first.

* Escape estimation is that of method D: a symbol seen n times in a context has (2n - 1) / (2 total), an escape distinct / (2 total).
* Symbol exclusion: after an escape, the symbols of the longer context count no more, neither in ``distinct`` nor in ``total``. They are
  all found in the shorter context too, so the exclusion needs only their number and the sum of their counts there (``shadow``).
* Below order 0 all byte values that order 0 has not seen are equally likely; 0xFE and 0xFF, no bytes of UTF-8, stand for what is before
  a text and for its end.

No task ever holds the model. Tasks cut the documents into blocks, write each block's normalised texts to a file in the shared folder and
hand on, for each block and shard, its distinct windows and words with their training counts, packed. Shards are by hash, so a frequent
window weighs no more than another. Each shard merges what all blocks sent; the trie's tables then follow by one grouping and one join an order; each
shard answers every block with the log probabilities of its windows and the counts of its words; and each block scores its file.
What is shuffled grows with the distinct windows and words of the blocks. File names are new for every attempt and reach the next
step in rows that Spark writes, so files of lost or repeated tasks are never read.

The base score is that of a unigram word model with one added to each count.

Defined results: null and empty texts are the end symbol alone; a null ``doc_id`` is not held out; repeated rows are scored and learned row by
row; other columns are ignored, whatever their names; an empty table gives no rows; without training texts every byte has
1 / 256 and every word 1 / (0 + 0 + 1). Texts are taken whole; a longer one makes a block of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.files import create, locate, new_folder
from tidewell.llm.runs import by_runs
from tidewell.llm.words import Texts, chunks, split_words, word_bytes
from tidewell.session import materialize

ORDER = 5
MAX_ORDER = 6  # with the symbol, seven bytes: a window stays a positive 64-bit number
BLOCK_BYTES = 24 << 20
SLICE_BYTES = 1 << 21
PARTS, HELD_OUT = 7, 2
BLANK, BEFORE, END = 0x20, 0xFE, 0xFF
PRIME = 2_147_483_647

SENT = "block string, shard int, windows binary, window_n binary, word_bytes binary, word_sizes binary, word_n binary, train_words long, train_docs long"
ANSWERED = "block string, shard int, windows binary, costs binary, word_bytes binary, word_sizes binary, word_n binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
FILE = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.large_binary())])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(PARTS)) == HELD_OUT, F.lit(False))


def normalise(texts: Texts) -> Texts:
    """Each text as its words in lower case with a blank between them; a word's bytes never hold a blank."""
    words = split_words(texts)
    size = words.end - words.start
    lower = word_bytes(words)
    data = np.full(int(size.sum()) + len(size), BLANK, np.uint8)
    starts = np.cumsum(size + 1) - (size + 1)
    places = np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)
    data[places] = np.frombuffer(lower.buffers()[2], np.uint8)
    ends = np.append(0, starts + size + 1)[words.first]
    # The blank after a text's last word goes.
    keep = np.ones(len(data), bool)
    keep[ends[1:][np.diff(words.first) > 0] - 1] = False
    return Texts(data[keep], ends - np.append(0, np.cumsum(np.diff(words.first) > 0)))


def windows(texts: Texts, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The window of each byte and of each text's end, and the text it belongs to."""
    size = np.diff(texts.offsets)
    ends = np.cumsum(size + 1) - 1
    stream = np.full(len(texts.data) + len(size), END, np.uint8)
    inside = np.ones(len(stream), bool)
    inside[ends] = False
    stream[inside] = texts.data
    text = np.repeat(np.arange(len(size)), size + 1)
    place = np.arange(len(stream)) - np.repeat(ends - size, size + 1)
    key = stream.astype(np.int64)
    for back in range(1, order + 1):
        before = np.full(len(stream), BEFORE, np.int64)
        before[back:] = stream[: len(stream) - back]
        before[place < back] = BEFORE
        key |= before << (8 * back)
    return key, text


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (keys % PRIME % shards).astype(np.int64)


def word_shards(words: pa.Array, shards: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(x) % shards for x in words.to_pylist()), np.int64, len(words))


def pack_words(words: pa.Array) -> tuple[bytes, bytes]:
    """All bytes of the words and their sizes."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype("<u4")
    return b"".join(words.to_pylist()), sizes.tobytes()


def unpack_words(data: list[bytes], sizes: list[bytes]) -> pa.LargeBinaryArray:
    size = np.frombuffer(b"".join(sizes), "<u4").astype(np.int64)
    offsets = np.append(0, np.cumsum(size))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(data))])


class Counts:
    """Distinct windows and words of a block with their training counts, merged slice by slice."""

    def __init__(self) -> None:
        self.keys, self.key_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.words: list[pa.Array] = []
        self.word_n: list[np.ndarray] = []
        self.train_words = self.train_docs = 0

    def add(self, texts: Texts, train: np.ndarray, order: int) -> None:
        """``texts`` are normalised; ``train`` tells which of them teach."""
        key, text = windows(texts, order)
        teaches = train[text]
        taught, n = np.unique(key[teaches], return_counts=True)
        others = np.unique(key[~teaches])
        none = np.zeros(len(others), np.int64)
        self.keys, self.key_n = _merged(np.concatenate([self.keys, taught, others]), np.concatenate([self.key_n, n, none]))
        words = split_words(texts)
        coded = word_bytes(words).dictionary_encode()
        codes = coded.indices.to_numpy()
        self.words.append(coded.dictionary)
        self.word_n.append(np.bincount(codes, train[words.text], minlength=len(coded.dictionary)).astype(np.int64))
        self.train_words += int(train[words.text].sum())
        self.train_docs += int(train.sum())
        if len(self.words) == 8:
            self._merge_words()

    def _merge_words(self) -> None:
        if self.words:
            words, n = merge_words(pa.concat_arrays(self.words), np.concatenate(self.word_n))
            self.words, self.word_n = [words], [n]

    def messages(self, block: str, shards: int) -> Iterator[pa.RecordBatch]:
        self._merge_words()
        shard = shard_of(self.keys, shards)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        words = self.words[0] if self.words else pa.array([], pa.large_binary())
        n = self.word_n[0] if self.words else np.zeros(0, np.int64)
        word_shard = word_shards(words, shards)
        word_order = np.argsort(word_shard, kind="stable")
        word_bounds = np.searchsorted(word_shard[word_order], np.arange(shards + 1))
        names = [x.split(" ")[0] for x in SENT.split(", ")]
        rows = []
        for at in range(shards):
            keys = order[bounds[at] : bounds[at + 1]]
            own = word_order[word_bounds[at] : word_bounds[at + 1]]
            learned = (self.train_words, self.train_docs) if not rows else (0, 0)
            if len(keys) or len(own):
                packed = pack_words(words.take(pa.array(own)))
                rows.append((block, at, self.keys[keys].tobytes(), self.key_n[keys].tobytes(), *packed, n[own].tobytes(), *learned))
        kinds = (pa.string(), pa.int32(), *[pa.binary()] * 5, pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def merge_words(words: pa.Array, n: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    coded = words.dictionary_encode()
    out = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(out, coded.indices.to_numpy(), n)
    return coded.dictionary, out


class BlockFile:
    """Normalised texts of a block in an Arrow file."""

    def __init__(self, folder: str) -> None:
        self.name, self.stream = create(folder, "texts")
        self.file = pa.ipc.new_file(self.stream, FILE, options=pa.ipc.IpcWriteOptions(compression="zstd"))

    def add(self, ids: pa.Array, held: pa.Array, texts: Texts) -> None:
        data = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(texts), [None, pa.py_buffer(texts.offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(texts.data))]
        )
        self.file.write_batch(pa.RecordBatch.from_arrays([ids, held, data], schema=FILE))

    def close(self) -> None:
        self.file.close()
        self.stream.close()


def read_block(name: str) -> Iterator[pa.RecordBatch]:
    system, path = locate(name)
    with system.open_input_file(path) as source:
        file = pa.ipc.open_file(source)
        for at in range(file.num_record_batches):
            yield file.get_batch(at)


def cut_blocks(docs: DataFrame, order: int, shards: int, block_bytes: int) -> DataFrame:
    """Write the blocks; rows of :data:`SENT` for each block and shard. ``block`` is the name of its file."""
    folder = new_folder(docs.sparkSession, "blocks")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = counts = None
        held = 0
        for batch in batches:
            for at, texts in chunks(batch.column("text"), SLICE_BYTES):
                if file is None:
                    file, counts, held = BlockFile(folder), Counts(), 0
                ids, out = (batch.column(x).slice(at, len(texts)) for x in ("doc_id", "held_out"))
                held += len(texts.data)
                clean = normalise(texts)
                file.add(ids, out, clean)
                counts.add(clean, ~out.to_numpy(zero_copy_only=False), order)
                if held >= block_bytes:
                    file.close()
                    yield from counts.messages(file.name, shards)
                    file = None
        if file:
            file.close()
            yield from counts.messages(file.name, shards)

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(task, SENT)


def merge_shards(sent: DataFrame) -> DataFrame:
    """Every distinct window of the corpus with its training count; a row without window counts the shard's distinct training words."""

    def work(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            run = table.slice(int(start), int(end - start))
            keys, n = _merged(*(np.frombuffer(b"".join(run[x].to_pylist()), np.int64) for x in ("windows", "window_n")))
            words = unpack_words(run["word_bytes"].to_pylist(), run["word_sizes"].to_pylist())
            word_n = merge_words(words, np.frombuffer(b"".join(run["word_n"].to_pylist()), np.int64))[1]
            yield _windows(run["shard"][0].as_py(), pa.array(keys), n)
            yield _windows(run["shard"][0].as_py(), pa.array([None], pa.int64()), np.array([(word_n > 0).sum()]))

    return by_runs(sent.drop("block", "train_words", "train_docs"), ["shard"], work, "shard int, window long, n long")


def _windows(shard: int, window: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard] * len(n), pa.int32()), window, pa.array(n.astype(np.int64))], ["shard", "window", "n"])


def trie_levels(longest: DataFrame, order: int) -> list[DataFrame]:
    """``window`` and ``n`` of orders 0 to ``order``; a window of a shorter order counts the longer ones it was met in."""
    levels = [longest]
    for k in range(order - 1, -1, -1):
        shorter = F.col("window").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1).cast("long")).alias("window")
        level = levels[0].groupBy(shorter).agg(F.sum((F.col("n") > 0).cast("long")).alias("n"))
        levels.insert(0, materialize(level, f"order_{k}"))
    return levels


def window_costs(longest: DataFrame, order: int) -> DataFrame:
    """``longest`` (``window``, ``n`` and more) with ``cost``, the log10 probability of the window's last byte after the others.

    From the lowest order up: ``after`` is the log probability that remains once the context of this order has been left by an escape.
    """
    seen = F.col("n") > 0
    # The symbols of one context: 256 rows at most.
    context = Window.partitionBy(F.shiftright("window", 8))
    distinct = F.sum(seen.cast("long")).over(context)
    total = F.sum("n").over(context)
    levels = trie_levels(longest, order)
    lower = levels[0].select("window", "n", distinct.alias("distinct"), total.alias("total"))
    lower = lower.withColumn("after", -F.log10(F.lit(256) - F.col("distinct")))
    for k in range(1, order + 1):
        names = {x: f"low_{x}" for x in lower.columns}
        low_window = F.col("window").bitwiseAND(F.lit((1 << (8 * k)) - 1).cast("long"))
        met = levels[k].withColumn("low_window", low_window).join(lower.withColumnsRenamed(names), "low_window")
        shadow = F.sum(F.when(seen, F.col("low_n")).otherwise(0)).over(context)
        met = met.withColumns({"distinct": distinct, "total": total, "shadow": shadow})
        mass = 2 * (F.col("low_total") - F.col("shadow"))
        new = F.col("low_distinct") - F.col("distinct")
        after = F.when(seen, 0.0).when(F.col("low_n") > 0, F.log10((2 * F.col("low_n") - 1) / mass))
        after = after.when(new > 0, F.log10(new / mass) + F.col("low_after")).otherwise(F.col("low_after"))
        lower = met.select(*levels[k].columns, "distinct", "total", after.alias("after"))
    cost = F.when(seen, F.log10((2 * F.col("n") - 1) / (2 * F.col("total"))))
    cost = cost.when(F.col("distinct") > 0, F.log10(F.col("distinct") / (2 * F.col("total"))) + F.col("after")).otherwise(F.col("after"))
    return lower.withColumn("cost", cost)


def answer(sent: DataFrame, costs: DataFrame) -> DataFrame:
    """For each block and shard: costs of its windows, and counts of its words over all blocks."""

    def work(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            run = table.slice(int(start), int(end - start)).combine_chunks()
            known = run.filter(pc.equal(run["kind"], 0))
            order = np.argsort(known["window"].to_numpy())
            window, cost = known["window"].to_numpy()[order], known["cost"].to_numpy()[order]
            asked = run.filter(pc.equal(run["kind"], 1))
            words = unpack_words(asked["word_bytes"].to_pylist(), asked["word_sizes"].to_pylist())
            coded = words.dictionary_encode()
            n = np.zeros(len(coded.dictionary), np.int64)
            np.add.at(n, coded.indices.to_numpy(), np.frombuffer(b"".join(asked["word_n"].to_pylist()), np.int64))
            counts, at = n[coded.indices.to_numpy()], 0
            for row in range(len(asked)):
                one = asked.slice(row, 1)
                keys = np.frombuffer(one["windows"][0].as_py(), np.int64)
                size = len(one["word_sizes"][0].as_py()) // 4
                found = cost[np.searchsorted(window, keys)] if len(keys) else np.zeros(0)
                packed = {"costs": found.tobytes(), "word_n": counts[at : at + size].tobytes()}
                at += size
                columns = [pa.array([packed[x]], pa.binary()) if x in packed else one[x].combine_chunks() for x in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = [x.split(" ")[0] for x in ANSWERED.split(", ")]
    ready = costs.select("shard", "window", "cost", F.lit(0).alias("kind"))
    both = ready.unionByName(sent.drop("window_n", "train_words", "train_docs").withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return by_runs(both, ["shard"], work, ANSWERED, order=["kind"])


def score_blocks(answers: DataFrame, train_docs: int, base_size: int, order: int) -> DataFrame:
    """Scores of the documents of each block's file. ``base_size`` is the denominator of the base score."""

    def of_batch(batch: pa.RecordBatch, window: np.ndarray, cost: np.ndarray, words: pa.Array, word_n: np.ndarray) -> pa.RecordBatch:
        _, offsets, data = batch.column("text").buffers()
        texts = Texts(np.frombuffer(data or b"", np.uint8), np.frombuffer(offsets, np.int64)[: batch.num_rows + 1])
        key, text = windows(texts, order)
        found, place = np.unique(key, return_inverse=True)
        score = np.bincount(text, cost[np.searchsorted(window, found)][place], minlength=len(texts))
        own = split_words(texts)
        coded = word_bytes(own).dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)
        n = word_n[at][coded.indices.to_numpy()]
        # The end is a token of every document; it is known if a document taught.
        base = np.bincount(own.text, np.log10((n + 1) / base_size), minlength=len(texts)) + np.log10((train_docs + 1) / base_size)
        n_known = np.bincount(own.text, n > 0, minlength=len(texts)).astype(np.int64) + (train_docs > 0)
        columns = [batch.column("doc_id"), batch.column("held_out"), *(pa.array(x) for x in (np.diff(own.first) + 1, n_known, base, score))]
        return pa.RecordBatch.from_arrays(columns, [x.split(" ")[0] for x in SCORED.split(", ")])

    def work(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            run = table.slice(int(start), int(end - start))
            window, cost = (np.frombuffer(b"".join(run[x].to_pylist()), t) for x, t in (("windows", np.int64), ("costs", np.float64)))
            by_window = np.argsort(window)
            words = unpack_words(run["word_bytes"].to_pylist(), run["word_sizes"].to_pylist())
            word_n = np.frombuffer(b"".join(run["word_n"].to_pylist()), np.int64)
            for batch in read_block(run["block"][0].as_py()):
                yield of_batch(batch, window[by_window], cost[by_window], words, word_n)

    return by_runs(answers, ["block"], work, SCORED, order=["shard"])


def score(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10 of the text's probability)."""
    if not 1 <= order <= MAX_ORDER:
        raise ValueError(f"order must be from 1 to {MAX_ORDER}")
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = materialize(cut_blocks(docs, order, shards, block_bytes), "sent", compression="zstd")
    merged = materialize(merge_shards(sent), "windows", compression="zstd")
    zero = F.lit(0).cast("long")
    learned = sent.agg(*(F.coalesce(F.sum(x), zero).alias(x) for x in ("train_words", "train_docs"))).first()
    distinct = merged.where(F.col("window").isNull()).agg(F.coalesce(F.sum("n"), zero).alias("n")).first()["n"]
    train_docs, tokens = learned["train_docs"], learned["train_words"] + learned["train_docs"]
    costs = window_costs(merged.where(F.col("window").isNotNull()), order)
    scored = score_blocks(answer(sent, costs), train_docs, tokens + distinct + (train_docs > 0) + 1, order)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
