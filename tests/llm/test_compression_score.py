"""The classifier against plain loops: sample, dictionaries, compressed sizes, logistic fit and scores."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
import xxhash
import zstandard

from tidewell.llm import compression_score


def sizes(dictionary, text):
    data = (text or "").encode()
    loaded = zstandard.ZstdCompressionDict(dictionary)
    packer = zstandard.ZstdCompressor(level=3, dict_data=loaded, write_content_size=False, write_dict_id=False)
    return sum(len(packer.compress(data[at : at + 1024])) for at in range(0, len(data), 1024))


def difference(good, bad, text):
    a, b = sizes(good, text), sizes(bad, text)
    return (b - a) / (b + a) if text else 0.0


def fit(values, truth):
    """Slope and shift that minimise the logistic loss with the ridge, by plain gradient steps on standardised values."""
    scale = np.std(values)
    x = np.array(values) / scale
    w = np.zeros(2)
    for _ in range(200_000):
        p = 1 / (1 + np.exp(-(w[0] * x + w[1])))
        slope = np.array([((p - truth) * x).sum(), (p - truth).sum()]) + 1e-3 * w
        w -= slope / (0.25 * (x @ x + len(x)))
        if abs(slope).max() < 1e-7:
            break
    return w[0] / scale, w[1]


def plain(docs, labels, rows):
    place = lambda x: xxhash.xxh64_intdigest(x.to_bytes(8, "little", signed=True), seed=42)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    known = {(x.doc_id, x.quality) for x in labels if x.quality in (0, 1) and zlib.crc32(str(x.doc_id).encode()) % 3 != 1}
    texts = {x.doc_id: x.text for x in docs}
    dictionaries, values, truth = {}, [], []
    for label in (0, 1):
        ids = sorted((x for x, quality in known if quality == label), key=lambda x: (signed(place(x)), x))[: 2 * rows]
        own = [texts[x] for x in ids if texts.get(x) and len(texts[x].encode()) <= 1 << 16]
        pieces = [data[at : at + 1024] for text in own[0::2] for data in [text.encode()] for at in range(0, len(data), 1024)]
        dictionaries[label] = zstandard.train_dictionary(1 << 16, pieces).as_bytes()
        values += own[1::2]
        truth += [label] * len(own[1::2])
    found = [difference(dictionaries[1], dictionaries[0], text) for text in values]
    slope, shift = fit(found, np.array(truth, float))
    share = [sum(1 for x in labels if x.quality == y and zlib.crc32(str(x.doc_id).encode()) % 3 != 1) for y in (0, 1)]
    shift += math.log(share[1] / share[0]) - math.log(sum(truth) / (len(truth) - sum(truth)))
    out = {}
    for row in docs:
        logit = slope * difference(dictionaries[1], dictionaries[0], row.text) + shift
        out[row.doc_id] = (zlib.crc32(str(row.doc_id).encode()) % 3 == 1, 1 / (1 + math.exp(-logit)))
    return out


@pytest.mark.parametrize("rows", [100, 1500])
def test_scores_equal_plain_loops(spark, rows):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    model = compression_score.train(docs, labels, rows)
    found = {x.doc_id: x for x in compression_score.score(docs, model).collect()}
    expected = plain(docs.collect(), labels.collect(), rows)
    assert found.keys() == expected.keys() and model.slope > 0
    for doc_id, (held_out, score) in expected.items():
        assert found[doc_id].held_out == held_out and found[doc_id].score == pytest.approx(score, abs=1e-4)
        assert found[doc_id].predicted == (found[doc_id].score >= 0.5)
