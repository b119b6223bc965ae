"""Token ids by a public tokenizer, exactly as the ``tokenizers`` library gives them for its file.

A byte-level BPE whose merges stand in the order of their ids is the same thing as a table of ranks, and the ``tiktoken`` engine encodes
by such a table in half the time of the library. The ranks are built from the tokenizer's own file. Texts with a very long run of white space or
of other characters, on which that engine is slow, and tokenizers of any other build are encoded by the library.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from tidewell.llm.words import Texts, chunks

SLICE_BYTES = 1 << 20
LONG_RUN = 1000
#: Fixed value: the published pattern of byte-level pre-tokenization, as the libraries have it built in.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in printable]
    return {chr(x): x for x in printable} | {chr(256 + at): x for at, x in enumerate(others)}


def ranks_of(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Ranks and special tokens of a tokenizer's file, or nothing if it is more than a table of ranks."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    pre, model, added = parts.get("pre_tokenizer") or {}, parts["model"], parts.get("added_tokens") or []
    plain = all(parts.get(x) is None for x in ("normalizer", "post_processor", "truncation", "padding"))
    byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    extras = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    simple = model.get("type") == "BPE" and not any(model.get(x) for x in extras)
    exact = all(x["special"] and not (x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"]) for x in added)
    if not (plain and byte_level and simple and exact):
        return None
    specials, alphabet = {x["content"]: x["id"] for x in added}, byte_alphabet()
    ranks = {bytes(map(alphabet.__getitem__, x)): rank for x, rank in model["vocab"].items() if x not in specials}
    pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
    merged = [model["vocab"]["".join(x)] for x in pairs]
    in_order = merged == sorted(merged) and len(ranks) == 256 + len(set(merged)) and sorted(ranks.values()) == list(range(len(ranks)))
    return (ranks, specials) if in_order and all(bytes([x]) in ranks for x in range(256)) else None


class Encoder:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them, without truncation and padding."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        found = ranks_of(path)
        self.engine = found and tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=found[0], special_tokens=found[1])
        self.specials = set(found[1]) if found else set()

    @property
    def vocabulary_size(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def has_long_run(self, texts: Texts) -> np.ndarray:
        """Which texts have more than :data:`LONG_RUN` bytes of white space, or of anything else, in a row."""
        space = _SPACE[texts.data]
        turns = np.flatnonzero(space[1:] != space[:-1]) + 1
        # Runs may reach over the ends of texts; only what lies inside counts.
        start = np.unique(np.concatenate([[0], turns, texts.offsets[:-1]]))
        start = start[start < len(texts.data)]
        long = start[np.diff(np.append(start, len(texts.data))) > LONG_RUN]
        out = np.zeros(len(texts), bool)
        out[np.searchsorted(texts.offsets, long, "right") - 1] = True
        return out

    def encode(self, texts: Texts) -> Iterator[np.ndarray]:
        """Ids of each text."""
        by_library = self.has_long_run(texts) if self.engine else np.ones(len(texts), bool)
        data, bounds = texts.data.tobytes(), texts.offsets.tolist()
        for start, end, library in zip(bounds[:-1], bounds[1:], by_library.tolist(), strict=True):
            text = data[start:end].decode()
            if library:
                yield np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            else:
                yield self.engine.encode_to_numpy(text, allowed_special=self.specials, disallowed_special=())


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def slices(texts: list[str], limit: int = 1 << 22) -> Iterable[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters."""
    start = size = 0
    for at, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_all(path: str, texts: pa.Array) -> Iterator[np.ndarray]:
    """Ids of each text of a column in turn, as little-endian 32-bit integers; null counts as empty."""
    held = encoder(path)
    for _, part in chunks(texts, SLICE_BYTES):
        yield from held.encode(part)
