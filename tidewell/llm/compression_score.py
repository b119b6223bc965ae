"""Quality classifier from compressed sizes.

Two Zstandard dictionaries are built, from good and from bad labelled texts. Every text is compressed with both, in pieces of
:data:`PIECE` bytes so that a dictionary helps all of a text and not only its beginning. The normalised difference of the summed sizes,
(bad - good) / (bad + good), becomes a probability by a logistic fit on labelled texts that no dictionary has seen.

Only the fit is bounded: of the labelled rows outside the held-out fold, for each label the ``2 * rows`` with the smallest hash of
their id, whose texts have at most ``longest`` bytes; every second row is for the dictionary, the others for the fit. All texts
are scored whole.

Defined results: null and empty texts have the difference 0. Without labelled texts of both kinds every score is 0.5. Labels
that are null are not used. Repeated rows are scored row by row. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

SAMPLE_ROWS = 1500
SAMPLE_BYTES = 1 << 16
DICTIONARY_BYTES = 1 << 16
PIECE = 1024
LEVEL = 3
FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class Model:
    """Two dictionaries (empty ones: nothing learned) and the logistic fit of the size difference."""

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    shift: float = 0.0

    def score(self, texts: list[str | None]) -> list[float]:
        return [_logistic(self.slope * x + self.shift) for x in differences(self.good, self.bad, texts)]


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


@cache
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=loaded, write_content_size=False, write_dict_id=False)


def _pieces(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[x : x + PIECE] for x in range(0, len(data), PIECE)]


def differences(good: bytes, bad: bytes, texts: list[str | None]) -> list[float]:
    if not good or not bad:
        return [0.0] * len(texts)
    by_good, by_bad = _compressor(good).compress, _compressor(bad).compress
    out = []
    for text in texts:
        pieces = _pieces(text)
        a = sum(len(by_good(x)) for x in pieces)
        b = sum(len(by_bad(x)) for x in pieces)
        out.append((b - a) / (b + a) if pieces else 0.0)
    return out


def fit_logistic(values: np.ndarray, labels: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and shift by Newton steps; the small ridge keeps separable data finite."""
    scale = float(values.std()) or 1.0
    columns = np.stack([values / scale, np.ones(len(values))], axis=1)
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(columns @ weights, -30, 30)))
        slope = columns.T @ (p - labels) + ridge * weights
        curve = (columns * (p * (1 - p))[:, None]).T @ columns + ridge * np.eye(2)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1])


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def training_labels(labels: DataFrame) -> DataFrame:
    known = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
    return known.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, longest: int) -> dict[int, list[str]]:
    """Texts by label, in the order of the hash of their ids; ``2 * rows`` for each label at most."""
    known = training_labels(labels)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("quality") == label).distinct().orderBy(*order).limit(2 * rows) for label in (0, 1)]
    ids = picked[0].unionByName(picked[1])  # at most 4 * rows pairs of numbers
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    found = texts.where(F.octet_length("text").between(1, longest)).join(F.broadcast(ids), "doc_id")
    found = found.withColumn("order", order[0]).orderBy("order", "doc_id", "text").limit(4 * rows).toArrow()
    out: dict[int, list[str]] = {0: [], 1: []}
    for label, text in zip(found.column("quality").to_pylist(), found.column("text").to_pylist(), strict=True):
        out[label].append(text)
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_BYTES) -> Model:
    """A model of the labelled texts outside the held-out fold."""
    sample = labelled_sample(docs, labels, rows, longest)
    seen = {label: [piece for text in texts[0::2] for piece in _pieces(text)] for label, texts in sample.items()}
    try:
        good, bad = (zstandard.train_dictionary(DICTIONARY_BYTES, seen[label]).as_bytes() for label in (1, 0))
    except zstandard.ZstdError:  # too few texts of a kind to build a dictionary from
        return Model()
    texts = sample[1][1::2] + sample[0][1::2]
    if not sample[1][1::2] or not sample[0][1::2]:
        return Model()
    truth = np.array([1.0] * len(sample[1][1::2]) + [0.0] * len(sample[0][1::2]))
    slope, shift = fit_logistic(np.array(differences(good, bad, texts)), truth)
    # The sample has about as many texts of either kind; the shift restores their shares among all labels.
    shares = dict(training_labels(labels).groupBy("quality").count().collect())
    shift += math.log(shares[1] / shares[0]) - math.log(truth.sum() / (len(truth) - truth.sum()))
    return Model(good, bad, slope, shift)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.score(batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    scored = narrow.mapInArrow(task, StructType([narrow.schema["doc_id"], StructField("score", DoubleType())]))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents whose score reaches ``least``, with all their columns."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array(model.score(batch.column("text").to_pylist()))
            yield batch.filter(pa.array(scores >= least, pa.bool_()))

    return docs.mapInArrow(task, docs.schema)
