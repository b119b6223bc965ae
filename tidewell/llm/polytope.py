"""Nearest neighbours by cosine with cross-polytope hashing.

Unit vectors are turned by three rounds of random signs and fast Hadamard transforms; the hash is the signed axis that is nearest. Several
such hashes, the last over fewer axes, give a table about one cell for :data:`CELL` distinct vectors. A query looks into the
:data:`PROBES` likeliest cells of each of :data:`TABLES` tables (more with the square root of the number of cells) and all that it finds there
is ranked by exact cosine in double precision.

Equal vectors are one candidate with its smallest ids, and one query, so copies are compared once however many there are. A cell of more
than :data:`BLOCK` vectors is cut into blocks that a query visits one by one, so no task holds more. Queries that have found
too few candidates are compared with all vectors, in blocks.

Defined results: rows whose vector is null, empty, zero, or holds a null or non-finite component, and rows without id, take no part. Vectors are
compared with those of their own dimension. Repeated rows (same id, same vector) count once; rows with the query's own id are never its
neighbours. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.runs import flatten
from tidewell.session import materialize

TABLES = 12
PROBES = 16
CELL = 100
BLOCK = 4096
SEED = 11


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Each row times the normalised Hadamard matrix of its size, a power of two."""
    n, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(n, -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return rows / np.sqrt(size)


def axes_of(count: int, size: int) -> list[int]:
    """Axes of each hash of a table, for ``count`` vectors of (padded) dimension ``size``."""
    cells, out = count / CELL, []
    while cells > 2 * size:
        out.append(size)
        cells /= 2 * size
    if cells >= 2:
        out.append(min(size, 1 << max(0, round(np.log2(cells / 2)))))
    return out


@cache
def signs(dimension: int, table: int, part: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension, table, part]).choice([-1.0, 1.0], (3, dimension))


def distances(units: np.ndarray, table: int, axes: list[int]) -> list[np.ndarray]:
    """For each hash, how far each signed axis is behind the nearest one (squared)."""
    size = 1 << max(0, (units.shape[1] - 1).bit_length())
    padded = np.zeros((len(units), size))
    padded[:, : units.shape[1]] = units
    out = []
    for part, count in enumerate(axes):
        turned = padded
        for flips in signs(size, table, part):
            turned = hadamard(turned * flips)
        both = np.concatenate([turned[:, :count], -turned[:, :count]], axis=1)
        out.append((both.max(axis=1, keepdims=True) - both) ** 2)
    return out


def own_cells(units: np.ndarray, table: int, axes: list[int]) -> np.ndarray:
    code = np.zeros(len(units), np.int64)
    for behind in distances(units, table, axes):
        code = code * behind.shape[1] + behind.argmin(axis=1)
    return code


def likely_cells(units: np.ndarray, table: int, axes: list[int], probes: int) -> np.ndarray:
    """The ``probes`` cells of each row with the least total distance, or all cells if there are fewer."""
    code = np.zeros((len(units), 1), np.int64)
    cost = np.zeros((len(units), 1))
    for behind in distances(units, table, axes):
        few = np.argsort(behind, axis=1, kind="stable")[:, :probes]
        code = (code[:, :, None] * behind.shape[1] + few[:, None, :]).reshape(len(units), -1)
        cost = (cost[:, :, None] + np.take_along_axis(behind, few, axis=1)[:, None, :]).reshape(len(units), -1)
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        code, cost = np.take_along_axis(code, best, axis=1), np.take_along_axis(cost, best, axis=1)
    return code


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their unit vectors, by dimension."""
    lists = batch.column("vector")
    sizes = np.diff(lists.offsets.to_numpy())
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        values = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), size)
        values = values / np.abs(values).max(axis=1, keepdims=True)  # keeps the squares of tiny and huge components finite
        yield rows, values / np.linalg.norm(values, axis=1, keepdims=True)


def cell_rows(vectors: DataFrame, queries: bool, count: int) -> DataFrame:
    """``dimension``, ``cell``, ``node``: the cells of candidates, or those that queries look into."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, units in matrices(batch) if batch.num_rows else ():
                axes = axes_of(count, 1 << max(0, (units.shape[1] - 1).bit_length()))
                cells = int(np.prod([2 * x for x in axes], dtype=np.float64))
                probes = round(PROBES * max(1.0, np.sqrt(cells / 512)))
                for table in range(TABLES if axes else 1):
                    found = likely_cells(units, table, axes, probes) if queries else own_cells(units, table, axes)[:, None]
                    node = np.repeat(flatten(batch, "node")[rows], found.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(node), units.shape[1], np.int32)), pa.array(found.ravel() * TABLES + table), pa.array(node)],
                        ["dimension", "cell", "node"],
                    )

    return vectors.select("node", "vector").mapInArrow(task, "dimension int, cell long, node long")


def in_blocks(candidates: DataFrame, probes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cut the cells with more than :data:`BLOCK` candidates; probes visit all blocks of a cell."""
    cell = ["dimension", "cell"]
    large = candidates.groupBy(*cell).count().where(F.col("count") > BLOCK)
    large = large.select(*cell, F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    placed = candidates.join(large, cell, "left").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    visits = probes.join(large, cell, "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return placed.drop("blocks"), visits.drop("blocks")


FOUND = "query long, node long, first_id long, score double"


def compare(placed: DataFrame, visits: DataFrame, vectors: DataFrame, keep: int) -> DataFrame:
    """For each visit the ``keep`` nearest candidates of its block (ties to the smaller first id)."""
    key = ["dimension", "cell", "block"]
    wide = vectors.select("node", "vector", F.col("ids")[0].alias("first_id"))
    rows = (
        placed.withColumn("asks", F.lit(0)).unionByName(visits.withColumn("asks", F.lit(1))).join(wide, "node")
        .repartition(*key).sortWithinPartitions(*key, "asks")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            keys = np.stack([flatten(batch, x).astype(np.int64) for x in [*key, "asks"]], axis=1)
            cuts = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))), len(keys)) if len(keys) else [0]
            out = [[], [], [], []]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                here, asks = tuple(keys[start][:3]), keys[start][3]
                if here != at:
                    at, held = here, []
                part = batch.slice(start, end - start)
                units = next(matrices(part))[1]
                if not asks:
                    held.append((flatten(part, "node"), flatten(part, "first_id"), units))
                elif held:
                    node, first, known = (np.concatenate(x) for x in zip(*held, strict=True))
                    held = [(node, first, known)]
                    for column, values in zip(out, nearest(flatten(part, "node"), units, node, first, known, keep), strict=True):
                        column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["query", "node", "first_id", "score"])

    return rows.mapInArrow(task, FOUND)


def nearest(query, asked, node, first, known, keep: int) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[], [], [], []]
    for start in range(0, len(asked), 256):
        part = asked[start : start + 256]
        rough = part @ known.T
        few = min(keep, len(known))
        # All that may belong to the nearest, also where rounding of the product has moved ties apart.
        least = np.partition(rough, len(known) - few, axis=1)[:, len(known) - few] - 1e-12
        a, b = np.nonzero(rough >= least[:, None])
        score = np.einsum("ij,ij->i", part[a], known[b])
        order = np.lexsort((first[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        kept = place < few
        for column, values in zip(out, (query[start + a], node[b], first[b], score), strict=True):
            column.append(values[kept])
    return [np.concatenate(x) for x in out]


def usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(embeddings: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (cosine) of the ``k`` nearest rows found for each query row."""
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["embedding"].alias("vector"), is_query.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).groupBy("vec_id", "vector").agg(F.max("asks").alias("asks"))
    keep = k + 1
    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.select("vector", "vec_id", smallest.alias("place")).where(F.col("place") <= keep)
    vectors = few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))  # at most k + 1 ids
    vectors = materialize(vectors.withColumn("node", F.monotonically_increasing_id()), "vectors")
    asking = materialize(rows.where("asks").join(vectors, "vector").select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")), "queries")
    count = vectors.count()

    asked = vectors.join(asking.select(F.col("query").alias("node")).distinct(), "node", "left_semi")
    placed, visits = in_blocks(cell_rows(vectors, False, count), cell_rows(asked, True, count))
    found = best_of(compare(placed, visits, vectors, keep), keep)
    found = materialize(found, "found")
    sizes = vectors.groupBy(F.size("vector").alias("dimension")).count()
    got = asked.select(F.col("node").alias("query"), F.size("vector").alias("dimension")).join(
        found.groupBy("query").agg(F.count("*").alias("got")), "query", "left"
    )
    short = got.join(F.broadcast(sizes), "dimension").where(F.coalesce("got", F.lit(0)) < F.least(F.lit(keep), F.col("count")))
    if not short.isEmpty():
        blocks = max(1, -(-count // BLOCK))
        every = vectors.select(F.size("vector").alias("dimension"), F.pmod(F.xxhash64("node"), F.lit(blocks)).alias("cell"), "node")
        asks = short.select("dimension", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).cast("long").alias("cell"), F.col("query").alias("node"))
        exact = compare(every.withColumn("block", F.lit(0)), asks.withColumn("block", F.lit(0)), vectors, keep)
        found = best_of(found.drop("place").unionByName(exact), keep)
    named = found.join(vectors.select("node", "ids"), "node").join(asking, "query")
    named = named.select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return named.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best_of(found: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` nearest of all tables and blocks for each query."""
    once = found.groupBy("query", "node", "first_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "first_id"))
    return once.withColumn("place", place).where(F.col("place") <= keep)
