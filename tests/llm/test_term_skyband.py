"""The audit against plain loops, and the skyband against its definition."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewell.llm import term_skyband


def plain(rows, top, min_docs=3):
    docs = [(text or "", lang or "", source or "") for text, lang, source in rows]
    counts, total, held = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        counts[lang, source].update(words)
        total[lang].update(words)
        held[lang].update(set(words))
    out = []
    share = lambda n, size: 1 + 10**9 * (n + 1) // size
    for lang, source in list(counts):
        kept = [x for x in total[lang] if held[lang][x] >= min_docs]
        size = lambda counter: sum(counter[x] for x in kept) + len(kept)  # noqa: E731, B023
        group = {x: share(counts[lang, source][x], size(counts[lang, source])) for x in kept}
        parts = {"pair": [], "term": []}
        for other_lang, other in list(counts):
            if other_lang == lang and other != source:
                q = {x: share(counts[lang, other][x], size(counts[lang, other])) for x in kept}
                parts["pair"].append((sum((group[x] - q[x]) ** 2 // q[x] for x in kept), other))
        q = {x: share(total[lang][x], size(total[lang])) for x in kept}
        parts["term"] = [((group[x] - q[x]) ** 2 // q[x], x) for x in kept if counts[lang, source][x] and group[x] > q[x]]
        for part, found in parts.items():
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(found, 1) if part == "pair" or rank <= top]
    return sorted(out)


def as_rows(df):
    return sorted((x.lang, x.source, x.part, x.item, x.value, x.rank) for x in df.collect())


@pytest.mark.parametrize("top", [1, 5, 200])
def test_audit_equals_plain_loops(spark, top):
    draw = random.Random(top)
    words = ["a", "B", "b", "été", "日本", "x1y", "zz", "q-r", "Éa", "😀", *(f"w{chr(97 + i)}" for i in range(26))]
    rows = [(None, None, None), ("", "de", ""), ("only here", "fr", "s1"), (None, "fr", "s2"), ("a a a", None, "s")]
    for _ in range(300):
        text = " ".join(draw.choices(words, [1 / (i + 1) for i in range(len(words))], k=draw.randint(0, 30)))
        rows.append((text, draw.choice(["en", "de", ""]), draw.choice(["s1", "s1", "s1", "s2", "Ss", "日"])))
    rows += [("copied text of one group " * 5, "en", "s1")] * 100  # a third of the rows
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(7)
    assert as_rows(term_skyband.audit(df, top)) == plain(rows, top)


def test_awkward_rows(spark, awkward, no_rows):
    rows = [(x.text, None, x.length) for x in awkward.collect()]
    df = awkward.drop("length").withColumnsRenamed({"kept": "lang", "node": "source"})
    expected = plain([(text, "clash", "clash") for text, _, _ in rows], 200)
    assert as_rows(term_skyband.audit(df)) == expected and any(x[2] == "term" for x in expected) is False
    empty = no_rows.withColumnsRenamed({"kept": "lang", "node": "source"})
    assert term_skyband.audit(empty).collect() == []


@pytest.mark.parametrize("k", [1, 3, 40])
def test_skyband_equals_its_definition(k):
    draw = np.random.default_rng(k)
    count, total = draw.integers(1, 40, 1500), draw.integers(1, 60, 1500)
    place = draw.permutation(1500)
    found = term_skyband.skyband(count, total, place, k)
    worse = (count[:, None] >= count) & (total[:, None] <= total) & (place[:, None] < place)
    assert (found == (worse.sum(axis=0) < k)).all()


def test_shares_do_not_overflow():
    counts = np.array([0, 5, 10**12, 3 * 10**15])
    sizes = np.array([1, 7, 10**13, 8 * 10**15])
    expected = [1 + 10**9 * (int(n) + 1) // int(s) for n, s in zip(counts, sizes, strict=True)]
    assert term_skyband.share(counts, sizes).tolist() == expected
