"""Encodings against the tokenizers library, packing and the token store against plain loops."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm import best_fit, encoding, prefix_bpe, token_store
from tidewell.llm.words import chunks

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = list("abcdefghijklmnopqrstuvwxyzéÉßΣσς'") + [
    "word", " ", "  ", "   ", "\n", "\n\n", "the", "ing", "<|endoftext|>", "<|startoftext|>", " The", "!!", "\x1c", "\t", "\r\n", "1", "23",
    "日本", "\u3000", "\u00a0", "'s", "e\u0301", "İ", "\x85", "…", "👍🏽", "#*", "</w>", "aaa", "\x00",
]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 30))) for _ in range(8000)]


def as_ids(data):
    return np.frombuffer(data, "<u4").tolist()


def by_text(encoder, texts):
    ((_, part),) = chunks(pa.array(texts), 1 << 30)
    return [x.tolist() for x in encoder.encode(part)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoding_equals_the_library(texts):
    expected = [x.ids for x in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in encoding.encode_all(BYTES, pa.array(texts))] == expected
    other = encoding.Encoder(WORDS)
    assert encoding.Encoder(BYTES).engine and not other.engine
    assert by_text(other, texts[:200]) == [x.ids for x in other.tokenizer.encode_batch(texts[:200], add_special_tokens=False)]


def test_encoding_of_every_code_point_and_token():
    library = Tokenizer.from_file(BYTES)
    points = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    texts = ["".join(f"a{x}1 {x}b\n{x}" for x in points[at : at + 8]) for at in range(0, len(points), 8)]
    texts += list(library.decode_batch([[x] for x in range(library.get_vocab_size())], skip_special_tokens=False))
    expected = [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert all(ours.tolist() == ids for ours, ids in zip(encoding.encode_all(BYTES, pa.array(texts)), expected, strict=True))


@pytest.mark.parametrize("unit", ["x", "ab", " ", "\n ", "日本", "!?", "7", "\u3000"])
def test_long_runs(unit):
    """Runs on which the engine would be slow, beside texts that are not long."""
    texts = ["short one", unit * 40_000, f"a {unit * 999} b", f"a {unit * 1001} b", "", "last"]
    library = Tokenizer.from_file(BYTES)
    assert by_text(encoding.encoder(BYTES), texts) == [x.ids for x in library.encode_batch_fast(texts, add_special_tokens=False)]


def test_prefix_encoding_equals_the_library(texts):
    library, ours = Tokenizer.from_file(WORDS), prefix_bpe.model(WORDS)
    ids = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [as_ids(ours.encode(text)) for text in texts] == ids
    assert [ours.decode(x) for x in ids] == library.decode_batch(ids, skip_special_tokens=False)
    assert as_ids(ours.encode("ab" * 5000)) == library.encode("ab" * 5000, add_special_tokens=False).ids


def test_prefix_encoding_of_documents(documents, awkward, no_rows):
    library = Tokenizer.from_file(WORDS)
    for df in (documents, awkward):
        expected = sorted(
            (repr(row.doc_id), ids := library.encode(row.text or "", add_special_tokens=False).ids, library.decode(ids, skip_special_tokens=False))
            for row in df.collect()
        )
        found = prefix_bpe.decode(prefix_bpe.encode(df, WORDS), WORDS).collect()
        assert sorted((repr(row.doc_id), row.ids, row.decoded) for row in found) == expected
    assert prefix_bpe.digests(prefix_bpe.decode(prefix_bpe.encode(no_rows, WORDS), WORDS)).collect() == []


class Tasks:
    """Stands for a table, to take hold of the function that an operator maps over its batches."""

    def select(self, *_):
        return self

    def mapInArrow(self, task, _):  # noqa: N802
        return task


def test_decoding_of_batches():
    """Null, empty and cut lists, every token and many ids, without a Python object for each id."""
    library = Tokenizer.from_file(WORDS)
    every = list(range(library.get_vocab_size()))
    lists = [None, [], every, [320], None, every[::-1], *[[x, x] for x in every[:300]], []]
    ids = pa.array([[1, 2], *lists], pa.list_(pa.int32())).slice(1)
    task = prefix_bpe.decode(Tasks(), WORDS)

    def decoded(numbers):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(numbers)), pa.int64()), numbers], ["doc_id", "ids"])
        return [text for part in task(iter([batch])) for text in part.column("decoded").to_pylist()]

    assert decoded(ids) == [library.decode(x or [], skip_special_tokens=False) for x in lists]
    many = pa.array([every * 10], pa.list_(pa.int32()))
    tracemalloc.start()
    try:
        for part in task(iter([pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), many], ["doc_id", "ids"])])):
            assert len(part) == 1
        assert tracemalloc.get_traced_memory()[1] < 8 * len(every) * 10
    finally:
        tracemalloc.stop()


def test_prefix_encoding_tries_a_pair_once(monkeypatch):
    """Also where the words are new and only their tokens were met before."""
    ours, calls = prefix_bpe.PrefixBPE(WORDS), []
    compatible = ours.compatible
    monkeypatch.setattr(ours, "compatible", lambda *pair: calls.append(pair) or compatible(*pair))
    text = "qzxlorentine vorbleyton grauwkelste unterplonkert " * 3
    first = ours.encode(text)
    assert calls and len(calls) == len(set(calls))
    ours.memo.clear()
    calls.clear()
    assert ours.encode(text) == first == np.array(Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids, "<i4").tobytes()
    assert not calls


def test_prefix_encoding_at_its_limits(monkeypatch):
    """Words and pairs are given up at small limits, and white space of any kind ends words."""
    for limit in ("MEMO_ENTRIES", "MEMO_WORD", "TRIED_PAIRS"):
        monkeypatch.setattr(prefix_bpe, limit, 3)
    library, ours = Tokenizer.from_file(WORDS), prefix_bpe.PrefixBPE(WORDS)
    spaces = [chr(x) for x in (9, 10, 11, 12, 13, 0x1C, 0x1F, 0x20, 0x85, 0xA0, 0x1680, 0x180E, 0x2000, 0x2007, 0x200B, 0x2028, 0x202F, 0x205F, 0x3000, 0xFEFF)]
    texts = [f"Straße{a}{b}it's{b}ΣΑΣ{a}12!{b}\u0301e\u0301" for a in spaces for b in spaces]
    for _ in range(2):
        found = [as_ids(x) for x in ours.encode_all(texts)]
        assert found == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert not ours.memo.long and len(ours.memo) <= 3


def test_bits():
    draw = np.random.default_rng(1)
    for width in (1, 3, 7, 8, 13, 16, 17, 31):
        ids = draw.integers(0, 2**width, 1000).astype("<u4")
        packed = token_store.pack_bits(ids, width)
        assert len(packed) == -(-1000 * width // 8) and (token_store.unpack_bits(packed, 1000, width) == ids).all()
    assert [token_store.width_for(x) for x in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


def test_token_store(documents, awkward, no_rows):
    library = Tokenizer.from_file(BYTES)
    for df in (documents, awkward):
        manifest = token_store.write_tokens(df, BYTES)
        found = token_store.read_tokens(manifest).collect()
        expected = sorted((repr(row.doc_id), [*library.encode(row.text or "", add_special_tokens=False).ids, 2]) for row in df.collect())
        assert sorted((repr(row.doc_id), as_ids(row.ids)) for row in found) == expected
        found.sort(key=lambda row: row.start)
        ids = [row.doc_id if row.doc_id is not None else -1 for row in found]
        assert ids == sorted(ids)  # null first
        assert [row.start for row in found] == np.append(0, np.cumsum([len(row.ids) // 4 for row in found]))[:-1].tolist()
        reader = token_store.ShardReader(manifest.orderBy("shard").first().path)
        assert as_ids(reader.ids(len(reader.documents) - 1)) == next(
            as_ids(row.ids) for row in found if row.start == reader.starts[-2]
        )  # one document by random access
    assert token_store.read_tokens(token_store.write_tokens(no_rows, BYTES)).collect() == []


def test_shards_of_odd_width_and_small_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK", 7)
    documents = [np.arange(n, dtype="<u4") % 5 for n in (0, 3, 20, 1, 7, 0)]
    path = str(tmp_path / "shard")
    with open(path, "wb") as stream:
        writer = token_store.ShardWriter(stream, 3)
        for number, ids in enumerate(documents):
            writer.add(number or None, ids)
        with pytest.raises(ValueError, match="3 bits"):
            writer.add(9, np.array([8], "<u4"))
        writer.close()
    reader = token_store.ShardReader(path)
    for place in (4, 0, 2, 5, 1, 3):
        assert (reader.ids(place) == documents[place]).all()


def test_plan_equals_best_fit_piece_by_piece():
    draw = random.Random(2)
    for _ in range(300):
        capacity = draw.choice([10, 50, 100])
        counts = {n: draw.randint(1, 7) for n in draw.sample(range(1, capacity + 1), draw.randint(1, 10))}
        slots = best_fit.plan(counts, capacity)
        filled = {}
        for length, count in counts.items():
            for number, offset in zip(*slots.take(np.full(count, length), np.arange(count)), strict=True):
                for place in range(offset, offset + length):
                    assert place < capacity and filled.setdefault((number, place), length) and True
        assert len(filled) == sum(n * count for n, count in counts.items())
        rooms = []
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fits = [x for x in rooms if x >= length]
                room = min(fits, default=capacity)
                if fits:
                    rooms.remove(room)
                rooms.append(room - length)
        assert slots.sequences == len(rooms)


@pytest.mark.parametrize("group", [best_fit.RANK_GROUP, 5])
def test_packing(documents, awkward, no_rows, monkeypatch, group):
    monkeypatch.setattr(best_fit, "RANK_GROUP", group)
    library = Tokenizer.from_file(BYTES)
    for df, capacity in ((documents, 2048), (awkward, 100)):
        pieces, placed = best_fit.pack(df, BYTES, end_id=0, capacity=capacity)
        rows = pieces.join(placed, "piece_key").collect()
        expected = []
        for row in df.collect():
            ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 0]
            first = (len(ids) - 1) % capacity + 1
            starts = [0, *range(first, len(ids), capacity)]
            for piece, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                expected.append((repr(row.doc_id), piece, start, end - start, crc(ids[start:end])))
        assert sorted((repr(x.doc_id), x.piece, x.start, x.length, zlib.crc32(x.ids)) for x in rows) == sorted(expected)
        at = {}
        for row in sorted(rows, key=lambda x: (x.sequence_id, x.offset)):
            assert at.get(row.sequence_id, 0) == row.offset
            at[row.sequence_id] = row.offset + row.length
        assert max(at.values()) <= capacity and len(at) <= 1.05 * sum(at.values()) / capacity + 1
        whole = {row.sequence_id: row for row in best_fit.sequences(pieces, placed).collect()}
        assert {number: row.length for number, row in whole.items()} == at
        assert all(len(row.ids) == 4 * row.length for row in whole.values())
    pieces, placed = best_fit.pack(no_rows, BYTES)
    assert placed.collect() == [] and pieces.agg(F.count("*")).first()[0] == 0
