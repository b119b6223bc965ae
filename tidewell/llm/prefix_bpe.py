"""BPE by dynamic programming over prefixes, for vocabularies of lower-cased words with word ends.

For every prefix of a word there is exactly one token that can end its encoding: of the tokens that match there (found
for all places at once by an automaton over the vocabulary), the one that is compatible with the token stored for the prefix before
it. Two tokens are compatible if no merge across their border comes before the merges that build them. Back-pointers from the
whole word then give its ids. The work grows with the length of the word times the number of matching tokens, also for words of a
million letters, where repeated merging would not end.

A border merge can only join a piece at the right edge of the left token with one at the left edge of the right token. Pieces exist
from their own merge to the merge of the piece around them, and merges happen in order of rank, the leftmost first where ranks are
equal. So the test is a look-up for each pair of edge pieces.

Defined results: null and empty texts have no ids and decode to the empty text. Repeated rows are encoded row by row. Other columns are
ignored, whatever their names. Special tokens written in a text get their ids, as the tokenizer gives them.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.encoding import slices

MEMO_ENTRIES = 400_000
MEMO_WORD = 32
TRIED_PAIRS = 200_000
SLICE = 1 << 20
NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next free one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def read_file(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def token_strings(parts: dict) -> list[str]:
    """The token of each id; ids that a file leaves out are empty."""
    numbers = parts["model"]["vocab"] | {x["content"]: x["id"] for x in parts["added_tokens"]}
    tokens = [""] * (max(numbers.values()) + 1)
    for token, number in numbers.items():
        tokens[number] = token
    return tokens


class Memo(dict):
    """Ids of words as little-endian 32-bit integers, made when a word is first asked for."""

    def __init__(self, word_ids: Callable[[str], list[int]]) -> None:
        self.word_ids = word_ids
        self.long: list[str] = []

    def __missing__(self, word: str) -> bytes:
        ids = self.word_ids(word)
        self[word] = packed = struct.pack(f"<{len(ids)}i", *ids)
        if len(word) > MEMO_WORD:
            self.long.append(word)
        return packed

    def trim(self) -> None:
        """Keep no long words, and not too many others."""
        for word in self.long:
            del self[word]
        self.long.clear()
        if len(self) > MEMO_ENTRIES:
            self.clear()


class PrefixBPE:
    def __init__(self, path: str) -> None:
        parts = read_file(path)
        model, steps = parts["model"], (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [x["type"] for x in (parts.get("normalizer") or {}).get("normalizers") or []]
        if kinds != ["NFC", "Replace", "Lowercase"] or steps[0].get("type") != "Split" or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path}: this encoder takes lower-cased words with a word-end suffix")
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        vocabulary: dict[str, int] = model["vocab"]
        added = {x["content"]: x["id"] for x in parts["added_tokens"]}
        self.tokens = token_strings(parts)
        self.added = added
        self.specials = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None

        # A word is written as one symbol a byte; its last byte is a symbol of its own (256 more), which stands for the word end.
        letters, suffix = byte_letters(), model["end_of_word_suffix"]
        symbols = {vocabulary[x]: chr(b) for b, x in enumerate(letters)} | {vocabulary[x + suffix]: chr(256 + b) for b, x in enumerate(letters)}
        self.built: dict[int, tuple[int, int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = (vocabulary[left], vocabulary[right])
            number = vocabulary[left + right]
            self.merges[pair] = rank
            if number not in self.built:
                self.built[number] = (rank, *pair)
                symbols[number] = symbols[pair[0]] + symbols[pair[1]]
        self.right_edge: dict[int, list[tuple[int, int]]] = {}
        self.left_edge: dict[int, list[tuple[int, int]]] = {}
        self.tried: dict[int, dict[int, bool]] = {}
        self.n_tried = 0
        whole = {number for number in symbols if number not in self.built}
        for number, (_, left, right) in self.built.items():
            if left in whole and right in whole and self._apart(left, right, (left, right)):
                whole.add(number)
        self.whole = whole
        self.automaton = ahocorasick.Automaton()
        for number in sorted(whole):
            self.automaton.add_word(symbols[number], (len(symbols[number]), number))
        self.automaton.make_automaton()
        self.memo = Memo(self.word_ids)

    def _edge(self, token: int, side: int, held: dict) -> list[tuple[int, int]]:
        """Pieces at one edge of a token, each with the rank of the merge that ends it."""
        if token not in held:
            out, until, piece = [], NEVER, token
            while True:
                out.append((piece, until))
                if piece not in self.built:
                    break
                until, piece = self.built[piece][0], self.built[piece][side]
            held[token] = out
        return held[token]

    def _apart(self, left: int, right: int, own: tuple[int, int] | None = None) -> bool:
        """Whether no merge crosses the border of two tokens, but for ``own``."""
        for a, a_ends in self._edge(left, 2, self.right_edge):
            for b, b_ends in self._edge(right, 1, self.left_edge):
                rank = self.merges.get((a, b))
                if rank is not None and rank < a_ends and rank <= b_ends and (a, b) != own:
                    return False
        return True

    def compatible(self, left: int, right: int) -> bool:
        """Try a pair that ``tried`` does not hold, and keep the result there."""
        if self.n_tried > TRIED_PAIRS:
            self.tried.clear()
            self.n_tried = 0
        self.n_tried += 1
        known = self.tried.setdefault(left, {})[right] = self._apart(left, right)
        return known

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word of the text (already normalised)."""
        data = word.encode()
        symbols = data[:-1].decode("latin-1") + chr(256 + data[-1])
        last: list[int | None] = [None] * len(symbols)
        size = [0] * len(symbols)
        tried, nothing = self.tried, {}
        for end, (length, token) in self.automaton.iter(symbols):
            if last[end] is None:
                before = end - length
                if before >= 0:
                    left = last[before]
                    if left is None:
                        continue
                    fits = tried.get(left, nothing).get(token)
                    if not (self.compatible(left, token) if fits is None else fits):
                        continue
                last[end], size[end] = token, length
        ids, at = [], len(symbols) - 1
        while at >= 0:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            # That the normaliser writes each white space as one blank changes no word, since no word holds any.
            text = unicodedata.normalize("NFC", text)
            # Letter by letter: a capital sigma at the end of a word gets no form of its own.
            return self.pattern.findall("".join(map(str.lower, text)) if "Σ" in text else text.lower())
        return self.pattern.findall(text.lower())

    def _parts(self, text: str) -> list[list[str] | int]:
        """Words of the stretches between special tokens, and those tokens' ids."""
        if self.specials is None or not any(x in text for x in self.added):
            return [self._words(text)]
        out, at = [], 0
        for found in self.specials.finditer(text):
            out += [self._words(text[at : found.start()]), self.added[found[0]]]
            at = found.end()
        return [*out, self._words(text[at:])]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; every distinct word is encoded once."""
        find = self.memo.__getitem__
        number = lambda x: np.array([x], "<i4").tobytes()
        out = []
        for text in texts:
            parts = self._parts(text)
            out.append(b"".join([number(part) if isinstance(part, int) else b"".join(map(find, part)) for part in parts]))
        self.memo.trim()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """Token strings with a blank between them, as the tokenizer's own decoding gives them where a file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


@cache
def model(path: str) -> PrefixBPE:
    """One model for each worker process and vocabulary."""
    return PrefixBPE(path)


@cache
def tokens(path: str) -> pa.Array:
    """Token strings by id, which is all that decoding takes of a file."""
    return pa.array(token_strings(read_file(path)), pa.large_string())


def decode_all(names: pa.Array, ids: pa.ListArray) -> pa.Array:
    """Decoded text of each list of ids, as :meth:`PrefixBPE.decode` gives it; null lists give the empty text."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))
    lists = pa.LargeListArray.from_arrays(np.append(0, ends), names.take(ids.flatten()))
    return pc.binary_join(lists, pa.scalar(" ", names.type)).cast(pa.string())


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = model(tokenizer)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for start, end in slices(texts, SLICE):
                ids = held.encode_all(texts[start:end])
                offsets = np.append(0, np.cumsum([len(x) // 4 for x in ids])).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                numbers = batch.column("doc_id").slice(start, end - start)
                yield pa.RecordBatch.from_arrays([numbers, pa.ListArray.from_arrays(offsets, values)], ["doc_id", "ids"])

    narrow = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(task, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` with the decoded text of ``ids`` as column ``decoded``; null ids give the empty text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = tokens(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = decode_all(names, part.column("ids"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), texts], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id long, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """``n_tokens`` and hashes of the ids and of the decoded text."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
