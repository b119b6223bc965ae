"""Counts and repeats against plain loops."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from tidewell.llm import repetition

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in lines
            lines.add(line)
    reach = [0] * len(words)
    for i in range(len(words)):
        for j in range(len(words)):
            size = 0
            while i != j and max(i, j) + size < len(words) and words[i + size] == words[j + size]:
                size += 1
            reach[i] = max(reach[i], size)
    covered = {j for i, size in enumerate(reach) if size >= repetition.MIN_REPEAT for j in range(i, i + size)}
    return [len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), again, len(inside), len(covered), max(reach, default=0)]


def verdict(row):
    n, repeated, covered, longest = row[0], row[4], row[5], row[6]
    failed = n < 20 or 100 * repeated > 30 * n
    return failed, not failed and covered <= repetition.MAX_COVERED * n and longest <= repetition.MAX_LONGEST


def test_counts_equal_plain_loops():
    draw = random.Random(3)
    parts = ["a", "b", "é ", " ", "\n", "#", "\x0b ", "ab c d e f g h i\n", "x y z "]
    texts = [None, "", " ", "a a a a", "\n\n", "a b\na b\n\n a b"]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(0, 50))) for _ in range(300)]
    found = repetition.measure_column(pa.array(texts))
    for place, text in enumerate(texts):
        row = [int(found[name][place]) for name in NAMES]
        assert row == plain(text), text
        assert (bool(found["base_failed"][place]), bool(found["kept"][place])) == verdict(row)


def test_slices_do_not_change_results(monkeypatch):
    texts = pa.array([f"w{i} again and again and again {i}\nline\nline" * (i % 3) for i in range(50)])
    whole = repetition.measure_column(texts)
    monkeypatch.setattr("tidewell.llm.words.chunks.__defaults__", (64,))
    cut = repetition.measure_column(texts)
    assert all((whole[name] == cut[name]).all() for name in whole)


def test_documents(documents):
    texts = {row.doc_id: row.text for row in documents.collect() if len(row.text or "") < 3000}
    rows = {row.doc_id: row for row in repetition.judge(documents).collect()}
    assert len(rows) == documents.count()
    for doc_id, text in list(texts.items())[:80]:
        expected = plain(text)
        assert [rows[doc_id][name] for name in NAMES] == expected
        assert (rows[doc_id].base_failed, rows[doc_id].kept) == verdict(expected)


def test_awkward_rows(awkward, no_rows):
    rows = repetition.judge(awkward).collect()
    assert len(rows) == awkward.count()
    assert [row.n_words for row in rows if row.doc_id == 5] == [60_000]
    kept = repetition.keep_clean(awkward)
    assert kept.columns == awkward.columns
    assert sorted(repr(row.doc_id) for row in kept.collect()) == sorted(["None", "3", "3", "6", "5"])
    assert repetition.judge(no_rows).collect() == [] and repetition.keep_clean(no_rows).collect() == []


@pytest.mark.parametrize("count", [0, 1, 2, 7])
def test_long_runs_of_one_word(count):
    found = repetition.measure_column(pa.array(["word " * count]))
    assert found["longest_repeat"][0] == max(0, count - 1)


@pytest.mark.parametrize(("size", "kept"), [(49, True), (50, False), (90, False)])
def test_a_passage_written_twice_in_a_long_text(size, kept):
    """The other limits hold, so the longest repeat alone decides."""
    words = [f"w{i}" for i in range(700)]
    words[400 : 400 + size] = words[100 : 100 + size]
    found = repetition.measure_column(pa.array([" ".join(words)]))
    assert not found["base_failed"][0] and found["covered_words"][0] == 2 * size <= repetition.MAX_COVERED * 700
    assert found["longest_repeat"][0] == size and found["kept"][0] == kept


def test_a_clean_long_text_stays():
    """500,000 words, as frequent as those of a language."""
    draw = random.Random(5)
    words = draw.choices([f"w{i}" for i in range(50_000)], [1 / (i + 1) for i in range(50_000)], k=500_000)
    found = repetition.measure_column(pa.array([" ".join(words)]))
    assert found["n_words"][0] == 500_000 and found["longest_repeat"][0] > 4 and found["kept"][0]
