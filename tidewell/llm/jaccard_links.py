"""Similarity join on word shingles: MinHash buckets, Bayesian pruning of candidates, exact verification.

1. Each text becomes its set of shingles (five lower-cased words; all words where there are fewer) and a signature of
   :data:`HASHES` MinHash values. Texts with equal sets are copies: they share one node and are never compared.
2. Nodes meet in buckets of :data:`ROWS` equal values, one bucket in each of :data:`BANDS` bands. A pair at the threshold
   0.8 misses all buckets with probability (1 - 0.8**5)**32 = 3e-6. A pair belongs to the first band in which it meets.
3. Pairs in a bucket are compared value by value. As soon as the posterior probability (uniform prior) that their similarity
   reaches the threshold falls below :data:`TOLERANCE`, they are dropped.
4. What is left is verified on the shingles of the whole texts.

A bucket of more than :data:`BLOCK` nodes is cut into blocks that meet in pairs, so a task's group has at most two blocks,
however many near copies there are. Pairs never leave a task: it hands on one row per node with its number of verified links and
the smallest node of its local component. Components of these rows are the classes. The work for a group of n different near copies grows as its n * n
comparisons, which counting the links of each asks for; the rows moved grow as n * n / BLOCK.

Defined results: null and empty texts, and texts without words, have no shingles: they are linked to nothing and form a class
each. Repeated rows are copies. A null ``doc_id`` counts as a document but never names a class unless no member has an id.
Other columns are ignored, whatever their names. Of rows that share both their id and their set of shingles :func:`keep_one` keeps the one with the
least 64-bit hash of its columns (maps aside).

Words and shingles are compared by 64-bit hashes, sets by 128 bits; n different shingles in two texts are confused with a chance of n * n / 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewell.llm.components import components
from tidewell.llm.runs import by_runs, fixed_rows, flatten
from tidewell.llm.words import chunks, constants, mix, shingle_hashes, split_words, word_hashes
from tidewell.session import materialize

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP = 32
TOLERANCE = 1e-6
BLOCK = 256

_FACTORS = constants(HASHES, 3)
_BAND_FACTORS = constants(ROWS, 4)
_BAND_SEEDS = constants(BANDS, 5)


def shingle_sets(texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and their bounds by text."""
    words = split_words(texts)
    hashes, bounds = shingle_hashes(word_hashes(words), words.first, WIDTH)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[first], text[first]
    return hashes, np.searchsorted(text, np.arange(len(texts) + 1))


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values (16 bits each) of the sets that are not empty, in order."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), HASHES), np.uint16)
    for k, factor in enumerate(_FACTORS):
        out[:, k] = mix(np.minimum.reduceat(hashes * factor, starts)) >> np.uint64(48) if len(starts) else 0
    return out


def lower(column: pa.Array | pa.ChunkedArray) -> pa.Array | pa.ChunkedArray:
    return pc.utf8_lower(column.cast(pa.large_string()))


def set_keys(hashes: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """Two 64-bit sums over the members of each set, 0 for an empty one."""
    full = np.diff(bounds) > 0
    keys = []
    for seed in (6, 7):
        key = np.zeros(len(full), np.uint64)
        if full.any():
            key[full] = np.add.reduceat(mix(hashes * constants(1, seed)[0]), bounds[:-1][full])
        keys.append(pa.array(key.view(np.int64)))
    return keys


FINGERPRINT = "doc_id long, text_key long, set_a long, set_b long, n_shingles int, signature binary"


def _fingerprint_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at, texts in chunks(lower(batch.column("text"))):
        hashes, bounds = shingle_sets(texts)
        size = np.diff(bounds)
        full = size > 0
        keys = set_keys(hashes, bounds)
        signed = signatures(hashes, bounds)
        binary = np.full(len(texts), None, object)
        binary[full] = [row.tobytes() for row in signed]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(x).slice(at, len(texts)) for x in ("doc_id", "text_key")), *keys, pa.array(size.astype(np.int32)), pa.array(binary, pa.binary())],
            ["doc_id", "text_key", "set_a", "set_b", "n_shingles", "signature"],
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: a hash of its text, a 128-bit key of its shingle set, the size of the set, and its signature."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _fingerprint_batch(batch)

    return _narrow(docs).mapInArrow(task, FINGERPRINT)


def _narrow(docs: DataFrame) -> DataFrame:
    text = docs["text"].cast("string")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def band_keys(signature: np.ndarray) -> np.ndarray:
    """The bucket of each row of ``signature`` in each band."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    return mix(mix((parts * _BAND_FACTORS).sum(axis=2, dtype=np.uint64)) + _BAND_SEEDS)


def bucket_rows(nodes: DataFrame) -> DataFrame:
    """``bucket``, ``band``, ``node``: every node in its bucket of every band."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(fixed_rows(pa.Table.from_batches([batch]), "signature", np.uint16))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.view(np.int64).ravel()),
                        pa.array(np.tile(np.arange(BANDS, dtype=np.int16), len(keys))),
                        pa.array(np.repeat(flatten(batch, "node"), BANDS)),
                    ],
                    ["bucket", "band", "node"],
                )

    return nodes.select("node", "signature").mapInArrow(task, "bucket long, band short, node long")


@cache
def least_matches(threshold: float) -> dict[int, int]:
    """For n compared values, the fewest matches with which the threshold is still possible beyond the tolerance.

    With a uniform prior, P(similarity >= t | m of n match) is the binomial probability of at most m in n + 1 with chance t.
    """
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while tail < TOLERANCE:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def block_pairs(block: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a group: within a block, or of one block with another."""
    if low == high:
        return np.triu_indices(len(block), 1)
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    return np.repeat(left, len(right)), np.tile(right, len(left))


def surviving(signature: np.ndarray, size: np.ndarray, band: int, pairs, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that belong to this band and may still reach the threshold."""
    a, b = pairs
    short, long = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
    fits = short >= threshold * long - 1e-9
    a, b = a[fits], b[fits]
    matches = np.zeros(len(a), np.int64)
    for n, least in least_matches(threshold).items():
        part = slice(n - STEP, n)
        matches += (signature[a, part] == signature[b, part]).sum(axis=1)
        alive = matches >= least
        a, b, matches = a[alive], b[alive], matches[alive]
    if band:
        keys = band_keys(signature)[:, :band]
        owned = ~(keys[a] == keys[b]).any(axis=1)
        a, b = a[owned], b[owned]
    return a, b


def _groups(table: pa.Table, bounds: np.ndarray) -> Iterator[tuple]:
    signature, size = fixed_rows(table, "signature", np.uint16), flatten(table, "n_shingles")
    band, block, low, high = (flatten(table, x) for x in ("band", "block", "low", "high"))
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if end - start > 1:
            yield start, end, signature[start:end], size[start:end], int(band[start]), block[start:end], int(low[start]), int(high[start])


GROUP = ["bucket", "low", "high"]
MEMBER = "bucket long, low int, high int, band short, block int, node long"


def candidate_members(met: DataFrame, threshold: float) -> DataFrame:
    """The rows of ``met`` whose node is in a pair that outlived the pruning in this group."""

    def work(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(len(table), bool)
        for start, _, signature, size, band, block, low, high in _groups(table, bounds):
            for side in surviving(signature, size, band, block_pairs(block, low, high), threshold):
                keep[start + side] = True
        yield from table.select(["bucket", "low", "high", "band", "block", "node"]).filter(pa.array(keep)).combine_chunks().to_batches()

    return by_runs(met, GROUP, work, MEMBER)


def common_counts(hashes: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``a[i]`` and ``b[i]``."""
    n = len(bounds) - 1
    ids = np.unique(hashes, return_inverse=True)[1]
    owner = np.repeat(np.arange(n), np.diff(bounds))
    often = np.bincount(ids)[ids] > 1
    ids, owner = np.unique(ids[often], return_inverse=True)[1], owner[often]
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    common = np.zeros((n, n), np.float32)
    last = int(ids[-1]) + 1 if len(ids) else 0
    for base in range(0, last, 4096):
        to = np.searchsorted(ids, [base, base + 4096])
        part = np.zeros((n, 4096), np.float32)
        part[owner[to[0] : to[1]], ids[to[0] : to[1]] - base] = 1
        common += part @ part.T
    return common[a, b].astype(np.int64)


def smallest_of_component(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for side in (a, b):
            np.minimum.at(root, root[side], low)
            np.minimum.at(root, side, low)
        root = root[root]
        if (root == before).all():
            break
    return root


VERIFIED = "node long, root long, text_links long, document_links long"


def verified(members: DataFrame, threshold: float) -> DataFrame:
    """Links of each node that belong to its groups, and the smallest node it is connected to there."""

    def work(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, copies = flatten(table, "node"), flatten(table, "n_copies")
        texts = lower(table.column("text")).combine_chunks()
        out: list[list[np.ndarray]] = [[], [], [], []]
        for start, end, signature, size, band, block, low, high in _groups(table, bounds):
            a, b = surviving(signature, size, band, block_pairs(block, low, high), threshold)
            if not len(a):
                continue
            parts = [shingle_sets(part) for _, part in chunks(texts.slice(start, end - start))]
            hashes = np.concatenate([part[0] for part in parts])
            sizes = np.concatenate([np.diff(part[1]) for part in parts])
            common = common_counts(hashes, np.append(0, np.cumsum(sizes)), a, b)
            linked = common >= threshold * (sizes[a] + sizes[b] - common) - 1e-9
            a, b = a[linked], b[linked]
            nodes, weight, n = node[start:end], copies[start:end], end - start
            order = np.argsort(nodes)
            place = np.empty(n, np.int64)
            place[order] = np.arange(n)
            root = nodes[order][smallest_of_component(n, place[a], place[b])[place]]
            links = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
            others = np.bincount(a, weight[b], n) + np.bincount(b, weight[a], n)
            has = links > 0
            for column, values in zip(out, (nodes, root, links, others), strict=True):
                column.append(values[has].astype(np.int64))
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(column)) for column in out], ["node", "root", "text_links", "document_links"]
            )

    return by_runs(members, GROUP, work, VERIFIED)


def in_blocks(rows: DataFrame, size: Column) -> DataFrame:
    """Cut buckets of ``size`` nodes into blocks; each row goes to every pair of blocks that its own block is in."""
    count = F.ceil(size / F.lit(BLOCK)).cast("int")
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("node"), count).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "size")
    )


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, the key of its set (``set_a``, ``set_b``), ``root`` (any number that stands for its class),
    ``class_id`` (the smallest id of the class), ``n_links`` (other documents at the threshold or above, copies included),
    ``n_text_links`` (other shingle sets at the threshold or above) and ``n_copies``.
    """
    prints = materialize(fingerprints(docs), "fingerprints")
    key = ["set_a", "set_b", "n_shingles"]
    nodes = (
        prints.where("n_shingles > 0")
        .groupBy(*key, "signature")
        .agg(
            F.min("doc_id").alias("first_id"),
            # The text of one of the rows with the smallest id; plain numbers, so that the aggregate hashes and need not sort.
            F.min_by("text_key", F.coalesce("doc_id", F.lit((1 << 63) - 1))).alias("text_key"),
            F.count("*").alias("n_copies"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = materialize(nodes, "nodes")
    rows = bucket_rows(nodes)
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    met = in_blocks(rows.join(shared, "bucket"), F.col("size"))
    met = met.join(nodes.select("node", "signature", "n_shingles"), "node")
    members = materialize(candidate_members(met, threshold), "members")

    wanted = members.select("node").distinct().join(nodes, "node")
    texts = _texts_of(_narrow(docs), wanted.withColumn("doc_id", F.coalesce("first_id", F.lit(-1))), key)
    linked = materialize(verified(members.join(texts, "node"), threshold), "links")

    root = components(linked.select("node", F.col("root").alias("other")))
    links = linked.groupBy("node").agg(F.sum("text_links").alias("text_links"), F.sum("document_links").alias("document_links"))
    of_class = nodes.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = of_class.groupBy("root").agg(F.min("first_id").alias("class_id"))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0).cast("long"))
    known = (
        of_class.join(names, "root")
        .join(links, "node", "left")
        .select(
            *key,
            "root",
            "class_id",
            (zero("document_links") + F.col("n_copies") - 1).alias("n_links"),
            zero("text_links").alias("n_text_links"),
            "n_copies",
        )
    )
    return (
        prints.select("doc_id", *key)
        .join(known, key, "left")
        .select(
            "doc_id",
            "set_a",
            "set_b",
            "root",
            F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
            zero("n_links").alias("n_links"),
            zero("n_text_links").alias("n_text_links"),
            F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"),
        )
    )


def _texts_of(docs: DataFrame, wanted: DataFrame, key: list[str]) -> DataFrame:
    """``wanted`` with the text of one of its documents.

    They meet on the id and the hash of the text, so rows without an id, or with one that repeats, are told apart. Should two texts of one
    id have one hash, the one whose set has the key of the node is taken.
    """
    columns = ["text", "node", *key, "signature", "n_copies"]
    met = docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))).join(wanted, ["doc_id", "text_key"]).select(columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(lower(batch.column("text"))):
                part = batch.slice(at, len(texts))
                same = np.ones(len(texts), bool)
                for name, found in zip(key, set_keys(*shingle_sets(texts)), strict=False):
                    same &= flatten(part, name) == found.to_numpy()
                yield part.filter(pa.array(same))

    return met.mapInArrow(task, met.schema).drop("set_a", "set_b").dropDuplicates(["node"])


def _has_word() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class (the one with the smallest id) with all its columns; documents without words all stay."""
    found = classes(docs, threshold).where("root is not null")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "set_a", "set_b")
    first = found.groupBy("root").agg(F.min(order).alias("first"))
    key = ["no_id", "id", "set_a", "set_b"]
    stay = first.select(F.col("first.unnamed").alias("no_id"), F.coalesce("first.doc_id", F.lit(0)).alias("id"), "first.set_a", "first.set_b")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(lower(batch.column("row").field("text"))):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(at, len(texts)), *set_keys(*shingle_sets(texts))], ["row", "set_a", "set_b"]
                )

    # The caller's row travels as one value, so its column names cannot clash with ours.
    worded = docs.where(_has_word()).select(F.struct(*(docs[x] for x in docs.columns)).alias("row"))
    keyed = worded.mapInArrow(task, StructType([*worded.schema, StructField("set_a", LongType()), StructField("set_b", LongType())]))
    own_id = F.col("row.doc_id").cast("long")
    keyed = keyed.withColumns({"no_id": own_id.isNull(), "id": F.coalesce(own_id, F.lit(0))}).join(stay, key, "left_semi")
    hashed = [F.col("row")[x.name] for x in docs.schema if "map<" not in x.dataType.simpleString()]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64(*hashed)))
    kept = keyed.withColumn("place", place).where("place = 1").select("row.*")
    return kept.unionByName(docs.where(~_has_word()))
