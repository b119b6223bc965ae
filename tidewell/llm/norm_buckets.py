"""Ranked lexical search: the best documents of each item by exact integer scores, with pruning by vector length.

A document is a vector of impacts, one coordinate for each term, and an item a vector of term weights; the score is their inner product.
Only coordinates of terms that some item holds can count, so a document is its impacts of those terms, and its length is theirs.

The search follows LEMP. Every task orders its vectors by length and takes them in buckets of :data:`BUCKET`. With the least score that
still helps an item (its ``least``), a bucket is passed over where the item's length times the bucket's largest length stays below it
(Cauchy-Schwarz). Inside a bucket the item's :data:`FOCUS` heaviest coordinates count exactly and the rest of both vectors is bounded by the
product of their remaining lengths; vectors whose bound stays below ``least`` fall. All others are scored again in 64-bit integers.
Bounds are doubles with a margin of 1e-9, far above their rounding, and fall only if strictly below, so ties are never lost.

A first pass takes the longest bucket of every task and merges what it finds to a ``least`` for each item, with which the second
pass over all buckets begins; each task then raises it by what it finds itself.

Items are taken in blocks of at most :data:`BLOCK_ITEMS` items and :data:`BLOCK_TERMS` terms (one item at least); what a block sends to the
tasks is bounded by that. Every block reads the documents once.

Defined results: null and empty texts have no terms, so such documents do not count in any statistic and such items find nothing; documents with
equal ids, and items with equal ids, are ranked each for itself; a null ``doc_id`` comes before all others among equal scores; other
columns are ignored, whatever their names; an empty table gives no rows. Texts are taken whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewell.llm.words import NO_LETTER_OR_DIGIT, chunks, split_words, word_bytes
from tidewell.session import materialize

TOP = 10
BUCKET = 1024
FOCUS = 4
BLOCK_ITEMS = 1024
BLOCK_TERMS = 8192
SLICE_BYTES = 1 << 22
MARGIN = 1 + 1e-9
NO_ID = -(1 << 63)

POSTINGS = "doc_id long, n long, terms binary, counts binary"
FOUND = "item_key long, item_id long, doc_id long, score long"


def terms_of(items: DataFrame) -> DataFrame:
    """``item_id`` and the distinct ``terms`` of each item, in the order of their bytes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in chunks(batch.column("text"), SLICE_BYTES):
                words = split_words(texts, NO_LETTER_OR_DIGIT)
                every = word_bytes(words).cast(pa.binary()).cast(pa.string())
                own = [sorted(set(every[a:b].to_pylist()), key=str.encode) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
                ids = batch.column("item_id").slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(own, pa.list_(pa.string()))], ["item_id", "terms"])

    narrow = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text"))
    return narrow.mapInArrow(task, "item_id long, terms array<string>")


@dataclass
class Block:
    """Some items: their keys and ids, the vocabulary of all of them, and each item's places in it."""

    keys: list[int]
    ids: list[int | None]
    vocabulary: list[str]
    terms: list[np.ndarray]


def blocks_of(items: DataFrame, most_items: int, most_terms: int) -> Iterator[Block]:
    """Blocks of items with terms, one after another; only one block is on the driver at a time."""
    keyed = materialize(terms_of(items).where(F.size("terms") > 0).withColumn("item_key", F.monotonically_increasing_id()), "items")
    held: list = []
    vocabulary: set[str] = set()

    def block() -> Block:
        place = {term: at for at, term in enumerate(sorted(vocabulary, key=str.encode))}
        own = [np.array([place[x] for x in row["terms"]], np.int64) for row in held]
        return Block([x["item_key"] for x in held], [x["item_id"] for x in held], list(place), own)

    for row in keyed.toLocalIterator():
        if held and (len(held) >= most_items or len(vocabulary.union(row["terms"])) > most_terms):
            yield block()
            held, vocabulary = [], set()
        held.append(row)
        vocabulary.update(row["terms"])
    if held:
        yield block()


def postings_of(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Each document with a term: ``n``, all its terms with repeats, and packed places and counts of those in ``vocabulary``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array([x.encode() for x in vocabulary], pa.large_binary())
        width = len(vocabulary)
        for batch in batches:
            for at, texts in chunks(batch.column("text"), SLICE_BYTES):
                words = split_words(texts, NO_LETTER_OR_DIGIT)
                coded = word_bytes(words).dictionary_encode()
                known = pc.index_in(coded.dictionary, value_set=listed).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                place = known[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.int64)
                hit = place >= 0
                pairs, counts = np.unique(words.text[hit] * width + place[hit], return_counts=True)
                bounds = np.searchsorted(pairs, np.arange(len(texts) + 1) * width)
                n = np.diff(words.first)
                rows = np.flatnonzero(n)
                terms, counts = (pairs % width).astype("<i4"), counts.astype("<i8")
                columns = [
                    batch.column("doc_id").slice(at, len(texts)).take(pa.array(rows)),
                    pa.array(n[rows].astype(np.int64)),
                    *(pa.array([x[bounds[i] : bounds[i + 1]].tobytes() for i in rows], pa.binary()) for x in (terms, counts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(task, POSTINGS)


def document_frequencies(postings: DataFrame, width: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(width, np.int64)
        for batch in batches:
            for packed in batch.column("terms").to_pylist():
                held[np.frombuffer(packed, "<i4")] += 1
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(held[seen])], ["term", "df"])

    rows = postings.select("terms").mapInArrow(task, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(width, np.int64)
    for row in rows.collect():  # one row for each term of the block at most
        out[row["term"]] = row["df"]
    return out


@dataclass
class Search:
    """What tasks need of a block: weights and lengths of its items, and the figures of all documents."""

    block: Block
    weights: list[np.ndarray]
    documents: int
    size: int
    top: int

    def impacts(self, n: int, counts: np.ndarray) -> np.ndarray:
        m = 100 - 90 + (90 * n * self.documents) // self.size
        return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class Best:
    """The best documents of one item so far, by score and then by smaller id."""

    def __init__(self, top: int, least: int) -> None:
        self.top, self.least = top, least
        self.score, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, score: np.ndarray, doc: np.ndarray) -> None:
        good = score >= self.least
        score, doc = np.append(self.score, score[good]), np.append(self.doc, doc[good])
        order = np.lexsort((doc, -score))[: self.top]
        self.score, self.doc = score[order], doc[order]
        if len(order) == self.top:
            self.least = max(self.least, int(self.score[-1]))


class Searcher:
    """Takes buckets of vectors, longest first, and keeps the best documents of each item."""

    def __init__(self, search: Search, least: np.ndarray) -> None:
        self.search, self.width = search, len(search.block.vocabulary)
        self.best = [Best(search.top, int(x)) for x in least]
        self.lengths = np.array([math.sqrt(sum(int(x) ** 2 for x in w)) for w in search.weights])
        self.focus = [np.argsort(-w, kind="stable")[:FOCUS] for w in search.weights]
        self.rest = [math.sqrt(max(0, sum(int(x) ** 2 for x in np.delete(w, f)))) for w, f in zip(search.weights, self.focus, strict=True)]
        self.passed = self.bounded = self.scored = 0

    def take(self, docs: np.ndarray, length: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """``rows``: places and impacts of each document; ``length``: their lengths, descending."""
        least = np.array([x.least for x in self.best])
        near = np.flatnonzero(self.lengths * length[0] * MARGIN >= least)
        self.passed += len(least) - len(near)
        if not len(near):
            return
        dense = np.zeros((self.width, len(docs)), np.int32)
        for at, (places, impacts) in enumerate(rows):
            dense[places, at] = impacts
        for item in near:
            terms, weights, focus = self.search.block.terms[item], self.search.weights[item], self.focus[item]
            # The list is in order of length: from some row on, Cauchy-Schwarz alone ends it.
            end = int(np.searchsorted(-length, -(self.best[item].least / (self.lengths[item] * MARGIN)), "right")) if self.lengths[item] else 0
            parts = dense[terms[focus], :end].astype(np.float64)
            left = np.sqrt(np.maximum(length[:end] ** 2 * MARGIN - (parts**2).sum(axis=0), 0))
            bound = (weights[focus] @ parts + self.rest[item] * left) * MARGIN
            chosen = np.flatnonzero(bound >= self.best[item].least)
            self.bounded += end - len(chosen)
            self.scored += len(chosen)
            if len(chosen):
                self.best[item].offer(weights @ dense[np.ix_(terms, chosen)], docs[chosen])

    def results(self) -> pa.RecordBatch:
        block = self.search.block
        sizes = [len(x.score) for x in self.best]
        docs = np.concatenate([x.doc for x in self.best])
        columns = [
            pa.array(np.repeat(np.array(block.keys, np.int64), sizes)),
            pa.array(block.ids, pa.int64()).take(pa.array(np.repeat(np.arange(len(sizes)), sizes))),
            pa.array(docs, pa.int64(), mask=docs == NO_ID),
            pa.array(np.concatenate([x.score for x in self.best])),
        ]
        return pa.RecordBatch.from_arrays(columns, ["item_key", "item_id", "doc_id", "score"])


def with_length(postings: DataFrame, search: Search) -> DataFrame:
    """Postings with impacts in place of counts and the ``length`` of each vector; vectors without a coordinate go."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.frombuffer(x, "<i8") for x in batch.column("counts").to_pylist()]
            impacts = [search.impacts(n, x) for n, x in zip(batch.column("n").to_pylist(), counts, strict=True)]
            lengths = np.array([math.sqrt(float((x.astype(np.float64) ** 2).sum())) for x in impacts])
            columns = [
                batch.column("doc_id"),
                batch.column("terms"),
                pa.array([x.astype("<i4").tobytes() for x in impacts], pa.binary()),
                pa.array(lengths, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "terms", "impacts", "length"])

    vectors = postings.where(F.octet_length("terms") > 0)
    return vectors.mapInArrow(task, "doc_id long, terms binary, impacts binary, length double")


def buckets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """Documents, lengths and vectors in buckets of ``size`` rows."""
    docs: list[int] = []
    lengths: list[float] = []
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        names = ("doc_id", "length", "terms", "impacts")
        for doc, length, terms, impacts in zip(*(batch.column(x).to_pylist() for x in names), strict=True):
            docs.append(NO_ID if doc is None else doc)
            lengths.append(length)
            rows.append((np.frombuffer(terms, "<i4"), np.frombuffer(impacts, "<i4")))
            if len(rows) == size:
                yield np.array(docs, np.int64), np.array(lengths), rows
                docs, lengths, rows = [], [], []
    if rows:
        yield np.array(docs, np.int64), np.array(lengths), rows


def run(vectors: DataFrame, search: Search, least: np.ndarray, first_only: bool, bucket: int) -> DataFrame:
    """The best documents of each task, ``top`` for each item at most. Vectors stay in their tasks; each task orders its own."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(search, least)
        for at, (docs, length, rows) in enumerate(buckets(batches, bucket)):
            if at == 0 or not first_only:
                searcher.take(docs, length, rows)
        yield searcher.results()

    return vectors.sortWithinPartitions(F.col("length").desc()).mapInArrow(task, FOUND)


def best_of(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each item with their ``rank``; first among the rows of some tasks, then among those."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first()]
    salted = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_key", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_key").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).drop("salt")


def search_block(docs: DataFrame, block: Block, top: int, bucket: int) -> DataFrame:
    postings = materialize(postings_of(docs, block.vocabulary), "postings", compression="zstd")
    totals = postings.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("size")).first()
    df = document_frequencies(postings, len(block.vocabulary))
    documents = totals["documents"]
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    search = Search(block, [weight[x] for x in block.terms], documents, totals["size"], top)
    vectors = materialize(with_length(postings, search), "vectors", compression="zstd")
    # Only scores above 0 count.
    least = np.ones(len(block.keys), np.int64)
    first = best_of(run(vectors, search, least, True, bucket), top)
    place = {key: at for at, key in enumerate(block.keys)}
    for row in first.where(F.col("rank") == top).select("item_key", "score").collect():  # one row for each item of the block at most
        least[place[row["item_key"]]] = row["score"]
    return best_of(run(vectors, search, least, False, bucket), top)


def search(
    items: DataFrame, docs: DataFrame, top: int = TOP, bucket: int = BUCKET, block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``top`` documents of each item with a score above 0."""
    spark: SparkSession = docs.sparkSession
    found = []
    for block in blocks_of(items, block_items, block_terms):
        found.append(search_block(docs, block, top, bucket).select("item_id", "rank", "doc_id", "score"))
        if len(found) == 16:  # many blocks: keep the plan short
            found = [materialize(reduce(DataFrame.unionByName, found), "ranked")]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def search_sql() -> str:
    """The same rows in SQL, every document against every item that shares a term with it."""
    return SQL


SQL = r"""
with terms as (
  select row_number() over () as doc, doc_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
),
held as (select doc, doc_id, term, count(*)::bigint as tf from terms group by all),
sizes as (select doc, sum(tf)::bigint as n from held group by doc),
corpus as (select count(*)::bigint as documents, sum(n)::bigint as size from sizes),
weights as (
  select term, floor(1000 * ln((2 * documents + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from held cross join corpus group by term, documents
),
impacts as (
  select h.doc, h.doc_id, h.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * documents) // size))) as part
  from held h join sizes using (doc) join weights using (term) cross join corpus
),
items as (select row_number() over () as item, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from benchmark),
wanted as (select distinct item, item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from items),
scored as (select item, item_id, doc, doc_id, sum(part)::bigint as score from wanted join impacts using (term) group by all),
ranked as (
  select *, row_number() over (partition by item order by score desc, doc_id)::int as rank from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""
