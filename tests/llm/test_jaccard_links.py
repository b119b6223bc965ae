"""Links and classes against the similarity of all pairs."""

from __future__ import annotations

import random
import time
from collections import Counter, defaultdict

import pytest

from tidewell.llm import jaccard_links
from tidewell.llm.components import components


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain(rows, threshold=0.8):
    """(links to other texts, links to other documents, class) of each row, by comparing all pairs of different sets."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    distinct, copies = list(set(sets) - {frozenset()}), Counter(sets)
    near = defaultdict(set)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            common = len(a & b)
            if common >= threshold * (len(a) + len(b) - common) - 1e-9:
                near[a].add(b)
                near[b].add(a)
    at = defaultdict(list)
    for place, one in enumerate(sets):
        at[one].append(place)
    for one, places in at.items():
        for other in [one, *near[one]] if one else []:
            parent[find(at[other][0])] = find(places[0])
            for place in places:
                parent[find(place)] = find(places[0])
    members = defaultdict(list)
    for place in range(len(rows)):
        members[find(place)].append(place)
    out = {}
    for place, (doc_id, _) in enumerate(rows):
        ids = [rows[x][0] for x in members[find(place)] if rows[x][0] is not None]
        one = sets[place]
        others = copies[one] - 1 + sum(copies[x] for x in near[one]) if one else 0
        out[place] = (doc_id, len(near[one]), others, min(ids, default=None))
    return sorted(out.values(), key=repr)


def ours(df):
    found = jaccard_links.classes(df)
    return sorted((tuple(row) for row in found.select("doc_id", "n_text_links", "n_links", "class_id").collect()), key=repr)


def near_copies(count, seed=1):
    """Copies of one text with a few words changed, some of them changed again, so that classes hang together by chains."""
    draw = random.Random(seed)
    base = [f"word{i}" for i in range(120)]
    rows = []
    for doc_id in range(count):
        words = list(draw.choice([base, rows[-1][1].split() if rows else base]))
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
        rows.append((doc_id, " ".join(words)))
    return rows


def test_documents(documents):
    rows = [(row.doc_id, row.text) for row in documents.collect()]
    assert ours(documents) == plain(rows)


@pytest.mark.parametrize("block", [256, 8])
def test_a_large_group_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_links, "BLOCK", block)
    rows = near_copies(90)
    found = ours(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found == plain(rows) and max(row[1] for row in found) > 20


def test_keep_one_leaves_the_first_of_each_class(spark):
    rows = near_copies(40)
    df = spark.createDataFrame([(*row, "x") for row in rows], "doc_id long, text string, `set key a` string")
    expected = {row[3] for row in plain(rows)}
    kept = jaccard_links.keep_one(df.drop("set key a"))
    assert kept.columns == ["doc_id", "text"] and sorted(row.doc_id for row in kept.collect()) == sorted(expected)


def test_awkward_rows(awkward, no_rows):
    rows = [(row.doc_id, row.text) for row in awkward.collect()]
    assert ours(awkward) == plain(rows)
    kept = jaccard_links.keep_one(awkward)
    assert kept.columns == awkward.columns
    prose = [row for row in kept.collect() if (row.text or "").startswith("one two")]
    assert [row.doc_id for row in prose] == [3]  # its copies, also the unnamed one, and the near copy go
    assert kept.where("doc_id in (1, 2)").count() == 2 and kept.where("doc_id = 8").count() == 2
    assert ours(no_rows) == [] and jaccard_links.keep_one(no_rows).collect() == []


def test_null_and_repeated_ids_are_not_multiplied(spark):
    """Thousands of different texts under no id, or under one, take no more work than under their own."""
    texts = [" ".join(f"w{(i * 7919 + j) % 4001}" for j in range(i, i + 12)) for i in range(3000)]
    found = []
    for ids in ([None] * 3000, [7] * 3000, range(3000)):
        rows = [row for doc_id, text in zip(ids, texts, strict=True) for row in ((doc_id, text), (doc_id, text + " more"))]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        started = time.monotonic()
        found.append((sorted((x.n_links, x.n_text_links) for x in jaccard_links.classes(df).collect()), time.monotonic() - started))
    assert found[0][0] == found[1][0] == found[2][0]
    assert max(found[0][1], found[1][1]) < 3 * found[2][1] + 5


def test_keep_one_takes_any_column_names_and_defined_ties(spark):
    names = ["row", "place", "id", "no_id", "set_a", "row key", "set key a", "set key b", "first", "unnamed"]
    text = "one two three four five six"
    rows = [(3, text, {"k": i}, *(f"{name} {i}" for name in names)) for i in range(40)] + [(9, text, {"k": 1}, *names)]
    schema = "doc_id long, text string, m map<string, int>, " + ", ".join(f"`{x}` string" for x in names)
    kept = []
    for parts in (1, 5):
        df = spark.createDataFrame(rows, schema).repartition(parts)
        out = jaccard_links.keep_one(df)
        assert out.columns == df.columns
        kept.append([tuple(x) for x in out.collect()])
    assert kept[0] == kept[1] and len(kept[0]) == 1 and kept[0][0] in rows[:40]


def test_texts_below_five_words(spark):
    rows = [(1, "a b c"), (2, "A  b c"), (3, "a b"), (4, "a b c d"), (5, None)]
    assert ours(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard_links.least_matches(0.8)
    assert list(least) == [32, 64, 96, 128, 160]
    assert all(0.4 * n < m < 0.8 * n for n, m in least.items())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (7, 7)], "node long, other long")
    found = {row.node: row.root for row in components(edges).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {101: 100, 102: 100}
