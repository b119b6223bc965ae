"""Ranked search against a loop over all documents, with buckets and blocks of several sizes."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewell.llm import norm_buckets


def terms(text):
    lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(items, docs, top=10):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    held = [(doc_id, words) for doc_id, words in held if words]
    df = Counter(x for _, words in held for x in words)
    documents, size = len(held), sum(sum(words.values()) for _, words in held)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, words in held:
            m = 100 - 90 + (90 * sum(words.values()) * documents) // size
            own = set(terms(text)).intersection(words)
            weight = {x: math.floor(1000 * math.log((2 * documents + 2) / (2 * df[x] + 1))) for x in own}
            score = sum(weight[x] * ((10**9 * words[x]) // (1000 * words[x] + 8 * m)) for x in own)
            if score > 0:
                scored.append((-score, -math.inf if doc_id is None else doc_id, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(scored, key=lambda x: x[:2])[:top], 1)]
    return sorted(out, key=repr)


def as_rows(df):
    return sorted(((x.item_id, x["rank"], x.doc_id, x.score) for x in df.collect()), key=repr)


def case(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "X-1", "日本"]
    text = lambda most: " ".join(draw.choices(words, [1 / (i + 1) for i in range(len(words))], k=draw.randint(0, most)))
    docs = [(i, text(60)) for i in range(300)] + [(i, "w3 w40 w41 the same copy") for i in range(300, 450)]
    docs += [(500, "w3 w50"), (500, "w3 w50"), (None, "w3 w50"), (501, None), (502, "... --")]
    items = [(i, text(12)) for i in range(12)] + [(3, "w3 w40 copy"), (90, None), (91, ""), (92, "unheard of"), (None, "w50 W50 w3")]
    return items, docs


@pytest.mark.parametrize(("bucket", "block_items", "block_terms", "top"), [(7, 1024, 8192, 10), (64, 5, 8192, 3), (1024, 1024, 15, 10)])
def test_search_equals_a_loop(spark, bucket, block_items, block_terms, top):
    items, docs = case(bucket)
    item_rows = spark.createDataFrame(items, "item_id long, text string")
    doc_rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = norm_buckets.search(item_rows, doc_rows, top, bucket, block_items, block_terms)
    assert as_rows(found) == plain(items, docs, top)


def test_pruning_leaves_vectors_out_and_loses_none():
    draw = np.random.default_rng(1)
    width, docs = 40, 4000
    dense = np.where(draw.random((docs, width)) < 0.2, draw.integers(1, 10**6, (docs, width)), 0)
    length = np.sqrt((dense.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-length)
    dense, length = dense[order], length[order]
    own = [np.sort(draw.choice(width, 6, replace=False)) for _ in range(20)]
    weights = [draw.integers(0, 9000, 6) for _ in own]
    block = norm_buckets.Block(list(range(20)), list(range(20)), [f"t{i}" for i in range(width)], own)
    searcher = norm_buckets.Searcher(norm_buckets.Search(block, weights, 1, 1, 10), np.ones(20, np.int64))
    for at in range(0, docs, 100):
        rows = [(np.flatnonzero(x), x[x > 0]) for x in dense[at : at + 100]]
        searcher.take(np.arange(at, at + 100), length[at : at + 100], rows)
    for item in range(20):
        score = dense[:, own[item]] @ weights[item]
        best = np.lexsort((np.arange(docs), -score))[:10]
        assert searcher.best[item].doc.tolist() == best.tolist() and searcher.best[item].score.tolist() == score[best].tolist()
    assert searcher.scored < 0.5 * 20 * docs and searcher.passed and searcher.bounded


def test_awkward_rows(spark, awkward, no_rows):
    items = awkward.withColumnRenamed("doc_id", "item_id").drop("kept")
    docs = [(x.doc_id, x.text) for x in awkward.collect()]
    assert as_rows(norm_buckets.search(items, awkward)) == plain(docs, docs)
    assert norm_buckets.search(items, no_rows).collect() == []
    empty = norm_buckets.search(items.where("false"), awkward)
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]
