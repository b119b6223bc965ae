"""The model against a trie of plain dictionaries with explicit exclusion sets."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidewell.llm import byte_contexts

END, BEFORE = 0xFF, 0xFE


def tokens(text):
    lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Trie:
    def __init__(self, order):
        self.order, self.counts = order, defaultdict(Counter)

    def learn(self, stream):
        padded = [BEFORE] * self.order + stream
        for at in range(self.order, len(padded)):
            for k in range(self.order, -1, -1):
                context = tuple(padded[at - k : at])
                known = padded[at] in self.counts[context]
                self.counts[context][padded[at]] += 1
                if known:  # update exclusion
                    break

    def cost(self, stream):
        padded = [BEFORE] * self.order + stream
        total = 0.0
        for at in range(self.order, len(padded)):
            excluded, symbol = set(), padded[at]
            for k in range(self.order, -1, -1):
                found = self.counts.get(tuple(padded[at - k : at]), {})
                left = {x: n for x, n in found.items() if x not in excluded}
                if not left:
                    continue
                if symbol in left:
                    total += math.log10((2 * left[symbol] - 1) / (2 * sum(left.values())))
                    break
                total += math.log10(len(left) / (2 * sum(left.values())))
                excluded.update(left)
            else:
                total += math.log10(1 / (256 - len(excluded)))
        return total


def plain(rows, order):
    trie, words, docs = Trie(order), Counter(), 0
    stream = lambda text: [*" ".join(tokens(text)).encode(), END]
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            trie.learn(stream(text))
            words.update(tokens(text))
            docs += 1
    n = sum(words.values()) + docs
    size = n + len(words) + (docs > 0) + 1
    out = []
    for doc_id, text in rows:
        own = tokens(text)
        base = sum(math.log10((words[x] + 1) / size) for x in own) + math.log10((docs + 1) / size)
        known = sum(words[x] > 0 for x in own) + (docs > 0)
        out.append((doc_id, is_held_out(doc_id), len(own) + 1, known, n, base, trie.cost(stream(text))))
    return out


def check(df, rows, order=byte_contexts.ORDER, **parameters):
    key = lambda x: (repr(x[0]), x[2], round(x[6], 6))
    found = sorted(map(tuple, byte_contexts.score(df, order, **parameters).collect()), key=key)
    expected = sorted(plain(rows, order), key=key)
    assert [x[:5] for x in found] == [x[:5] for x in expected]
    for one, two in zip(found, expected, strict=True):
        assert one[5:] == pytest.approx(two[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize(("order", "block_bytes"), [(1, 1 << 20), (3, 4000), (6, 20_000)])
def test_scores_equal_a_plain_trie(spark, documents, order, block_bytes):
    rows = [(x.doc_id, x.text) for x in documents.collect() if len(x.text or "") < 600]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(df, rows, order, block_bytes=block_bytes)


def test_production_order_and_held_out_quality(spark, documents):
    """All of the small table; longer contexts make held-out texts likelier."""
    rows = [(x.doc_id, x.text) for x in documents.collect()]
    check(documents, rows)
    held = [sum(x.score for x in byte_contexts.score(documents, order).collect() if x.held_out) for order in (1, 5)]
    assert 0.9 * held[0] < held[1] < 0


def test_slices_do_not_change_scores(spark, documents, monkeypatch):
    monkeypatch.setattr(byte_contexts, "SLICE_BYTES", 300)
    rows = [(x.doc_id, x.text) for x in documents.limit(40).collect()]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, block_bytes=3000)


def test_awkward_rows(spark, awkward, no_rows):
    check(awkward, [(x.doc_id, x.text) for x in awkward.collect()])
    assert byte_contexts.score(no_rows).collect() == []
    alone = [x for x in range(100) if is_held_out(x)][:3]
    rows = [(x, text) for x, text in zip(alone, ("Never taught", "", None), strict=True)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    with pytest.raises(ValueError, match="order"):
        byte_contexts.score(awkward, 7)
