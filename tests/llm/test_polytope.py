"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidewell.llm import polytope


def plain(rows, asks, k=5):
    """{query id: [(vec_id, cosine)]} over rows of (id, vector), the nearest first, ties to the smaller id."""
    ids = np.array([row[0] for row in rows])
    vectors = np.array([row[1] for row in rows], float)
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for place, number in enumerate(ids.tolist()):
        if asks(number):
            score = np.einsum("ij,j->i", units, units[place])
            order = [x for x in np.lexsort((ids, -np.round(score, 12))) if ids[x] != number][:k]
            out[number] = [(int(ids[x]), float(score[x])) for x in order]
    return out


def found_by(df, k=5, every=50):
    out = {}
    for row in polytope.search(df, F.col("vec_id") % every == 0, k).collect():
        out.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    return {query: sorted(rows) for query, rows in out.items()}


def test_recall_and_exact_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in df.collect()]
    expected, found = plain(rows, lambda x: x % 50 == 0), found_by(df)
    assert found.keys() == expected.keys()
    vectors = {number: np.array(vector, float) for number, vector in rows}
    hits = 0
    for query, near in found.items():
        assert [rank for rank, _, _ in near] == [1, 2, 3, 4, 5]
        assert [(-s, v) for _, v, s in near] == sorted((-s, v) for _, v, s in near)
        for _, number, score in near:
            a, b = vectors[query], vectors[number]
            assert abs(score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
        hits += len({v for _, v, _ in near} & {v for v, _ in expected[query]})
    assert hits >= 0.9 * 5 * len(expected)


def test_recall_with_many_cells(spark, monkeypatch):
    """Cells far smaller than those of the tables above."""
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(6000, 32)) + draw.normal(size=(20, 32))[draw.integers(0, 20, 6000)]
    rows = [(i, vector.tolist()) for i, vector in enumerate(vectors)]
    monkeypatch.setattr(polytope, "CELL", 12)  # used where the tasks are made
    found = found_by(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=100)
    expected = plain(rows, lambda x: x % 100 == 0)
    hits = sum(len({v for _, v, _ in found[q]} & {v for v, _ in near}) for q, near in expected.items())
    assert hits >= 0.9 * 5 * len(expected)


def test_copies_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(polytope, "BLOCK", 16)
    draw = np.random.default_rng(2)
    common = [1.0] * 8
    rows = [(i, common if i % 3 == 0 else (np.ones(8) + 0.05 * draw.normal(size=8)).tolist()) for i in range(400)]
    found = found_by(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    rows = [(i, np.float32(vector).tolist()) for i, vector in rows]
    for query, near in plain(rows, lambda x: x % 50 == 0).items():
        assert [v for _, v, _ in found[query]] == [v for v, _ in near]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
        (8, [1e-200, 0.0]), (9, [1e200, 1e200]), (None, [1.0, 0.0]), (50, [1.0, 0.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (100, None),
    ]
    df = spark.createDataFrame([(*row, "c", "c") for row in rows], "vec_id long, embedding array<double>, score string, node string")
    found = found_by(df)
    assert [(v, round(s, 9)) for _, v, s in found[0]] == [(8, 1.0), (1, round(0.5**0.5, 9)), (9, round(0.5**0.5, 9))]
    assert found.keys() == {0}  # the only vector of three components has no candidate
    assert found_by(df.where("false")) == {}


def recall_on_two_full_hashes(spark, dimension=8, count=27_000, every=100):
    """Of the query with its own parameters, on normal vectors so many that tables have two hashes over all axes."""
    assert polytope.axes_of(count, dimension)[:2] == [dimension, dimension]
    vectors = np.random.default_rng(3).normal(size=(count, dimension))
    rows = list(enumerate(vectors.tolist()))
    found = found_by(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=every)
    expected = plain(rows, lambda x: x % every == 0)
    hits = sum(len({v for _, v, _ in found[q]} & {v for v, _ in near}) for q, near in expected.items())
    return hits / (5 * len(expected))


def test_recall_on_two_full_hashes(spark):
    assert recall_on_two_full_hashes(spark) >= 0.9
