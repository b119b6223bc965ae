"""Quality rules on repeated text: plain counts, and repeats found with suffix arrays.

All words of a slice of texts are sorted as suffixes at once (prefix doubling; only suffixes that are not yet told apart are
sorted again), texts never compare across their ends. Longest common prefixes of neighbours in that order come from the kept
ranks of each doubling. Each suffix so gets the longest repeat that starts at it; the union of these spans is the repeated part
of the text, and the largest of them its longest repeat.

Defined results: a null or empty text has no words and fails the base rules; repeated rows are judged each for itself; other
columns, whatever their names, are carried by :func:`keep_clean` and ignored by :func:`judge`. Texts are taken whole; memory
is bounded by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.words import Texts, Words, chunks, span_hashes, split_words, word_hashes

MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30
#: The method's own limits: repeats of at least so many words count, they may cover so much of the text, and none may be longer.
#: The last is the published rule that a run of 50 tokens found again is a copy (Lee et al. 2022, "Deduplicating Training Data Makes Language
#: Models Better"); a word is one token at least, so 50 words are.
MIN_REPEAT = 4
MAX_COVERED = 0.30
MAX_LONGEST = 49

SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " covered_words long, longest_repeat long, base_failed boolean, kept boolean"
)


def suffix_ranks(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of all suffixes by (text, words), and the ranks after each doubling: equal in level ``k``, equal in ``2**k`` words."""
    n = len(ids)
    end = np.searchsorted(text, text, "right")
    order = np.lexsort((ids, text))
    new = np.ones(n, bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (text[order][1:] != text[order][:-1])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, sizes)
    levels = [rank.copy()]
    open_ = order[np.repeat(sizes > 1, sizes)]
    step = 1
    while len(open_):
        after = open_ + step
        follow = np.where(after < end[open_], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + follow
        by_key = np.argsort(key, kind="stable")
        open_, key = open_[by_key], key[by_key]
        group = rank[open_]
        place = np.arange(len(open_))
        starts_group = np.append(True, group[1:] != group[:-1])
        starts_key = np.append(True, key[1:] != key[:-1])
        group_at = np.maximum.accumulate(np.where(starts_group, place, 0))
        key_at = np.maximum.accumulate(np.where(starts_key, place, 0))
        rank[open_] = group + key_at - group_at
        sizes = np.diff(np.append(np.flatnonzero(starts_key), len(open_)))
        open_ = open_[np.repeat(sizes > 1, sizes)]
        levels.append(rank.copy())
        step *= 2
    return rank, levels


def longest_repeats(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest run that starts there and occurs elsewhere in the same text."""
    n = len(ids)
    if n < 2:
        return np.zeros(n, np.int64)
    rank, levels = suffix_ranks(ids, text)
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    left, right = suffixes[:-1], suffixes[1:]
    pair = np.flatnonzero(levels[0][left] == levels[0][right])
    a, b = left[pair].copy(), right[pair].copy()
    common = np.zeros(len(pair), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        ranks = levels[level]
        same = (a < n) & (b < n)
        same[same] = ranks[a[same]] == ranks[b[same]]
        common[same] += 1 << level
        a[same] += 1 << level
        b[same] += 1 << level
    lcp = np.zeros(n + 1, np.int64)
    lcp[pair + 1] = common
    longest = np.empty(n, np.int64)
    longest[suffixes] = np.maximum(lcp[:-1], lcp[1:])
    return longest


def covered(reach: np.ndarray) -> np.ndarray:
    """Which words lie in the union of spans that start at each word and are ``reach`` long."""
    place = np.arange(len(reach))
    return np.maximum.accumulate(place + reach) > place if len(reach) else np.zeros(0, bool)


def count_by(text: np.ndarray, chosen: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text[chosen], minlength=n).astype(np.int64)


def repeated_lines(texts: Texts, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    start = np.unique(np.concatenate([texts.offsets[:-1], breaks + 1]))
    start = start[start < len(texts.data)]
    if not len(start):
        return np.zeros(len(texts), np.int64)
    text = np.searchsorted(texts.offsets, start, "right") - 1
    end = np.minimum(np.append(start[1:], len(texts.data)), texts.offsets[text + 1])
    end = end - (texts.data[end - 1] == 0x0A)
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, text = start[has_word], end[has_word], text[has_word]
    hashes = span_hashes(texts.data, start, end)
    order = np.lexsort((hashes, text))
    again = np.zeros(len(order), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    return np.bincount(text[order][again], minlength=len(texts)).astype(np.int64)


def measure(texts: Texts) -> dict[str, np.ndarray]:
    """All columns of :data:`SCHEMA` but ``doc_id`` for each text."""
    n = len(texts)
    words = split_words(texts)
    ids = np.unique(word_hashes(words), return_inverse=True)[1]
    longest = longest_repeats(ids, words.text)
    n_words = np.diff(words.first)
    points = np.concatenate([[0], np.cumsum(words.in_word & ((texts.data & 0xC0) != 0x80))])
    symbols = np.concatenate([[0], np.cumsum(np.isin(texts.data, SYMBOLS))])
    in_window = covered(np.where(longest >= WINDOW, WINDOW, 0))
    in_repeat = covered(np.where(longest >= MIN_REPEAT, longest, 0))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, words.text, longest)
    out = {
        "n_words": n_words,
        "word_chars": np.diff(points[texts.offsets]),
        "n_symbols": np.diff(symbols[texts.offsets]),
        "n_dup_lines": repeated_lines(texts, words),
        "n_repeat_words": count_by(words.text, in_window, n),
        "covered_words": count_by(words.text, in_repeat, n),
        "longest_repeat": top,
    }
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * n_words)
    within = (out["covered_words"] <= MAX_COVERED * n_words) & (top <= MAX_LONGEST)
    out["kept"] = ~out["base_failed"] & within
    return out


def measure_column(column: pa.Array) -> dict[str, np.ndarray]:
    parts = [measure(texts) for _, texts in chunks(column)]
    return {name: np.concatenate([part[name] for part in parts]) for name in parts[0]} if parts else {}


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, its repeats and whether it is kept."""
    names = [field.strip().split(" ")[0] for field in SCHEMA.split(",")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = measure_column(batch.column("text"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[x]) for x in names[1:])], names)

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(task, SCHEMA)


def keep_clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(measure_column(batch.column("text"))["kept"]))

    return docs.mapInArrow(task, docs.schema)
