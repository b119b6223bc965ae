"""Terms that set a source apart within its language: exact divergences, the top terms by dominance skybands.

Each language keeps the terms that at least :data:`MIN_DOCS` of its documents hold. A source's share of a term is
``p = 1 + floor(10**9 * (count + 1) / (N + V))`` (N: its kept terms with repeats, V: the kept terms of the language), the language's share
``q`` likewise, and the divergence ``floor((p - q)**2 / q)``. All of it is integer arithmetic.

Among terms with ``p > q`` the divergence cannot fall when the source's count grows or the language's count shrinks, and equal values rank
by UTF-8. So a term with ``k`` others of at least its source count, at most its language count and earlier in UTF-8 is not among the first
``k``. Terms are dealt over tasks by language and salt; each task keeps, for each source, the terms with fewer than ``k`` such others (the
skyband of its terms). Skybands of :data:`MERGE` tasks are merged to one, and only what is left is ranked exactly. A term dominated by ``k``
others is dominated by ``k`` members of the skyband, so a task needs to hold no other terms.

The comparison of each two sources of a language sums the divergence over all kept terms. A task sums its own terms for all pairs of
sources, one source at a time against a dense block, and hands on one row for each pair; the result itself has a row for each pair.

Defined results: null text, lang and source count as empty ones; documents without terms still make their group occur; without kept terms every
pair has the value 0 and no term is listed; repeated rows and ids are documents each for itself; other columns, whatever their names, are
ignored; an empty table gives no rows. Texts are taken whole. Counts are exact up to 9e15 terms in a language (the division below).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.runs import by_runs
from tidewell.llm.words import NO_LETTER, chunks, split_words, word_bytes
from tidewell.session import materialize

MIN_DOCS = 3
TOP = 200
MERGE = 32
BLOCK = 512
SLICE_BYTES = 1 << 23

PARTIAL = "lang string, source string, term string, n long, docs long"
FOUND = "lang string, source string, part string, item string, value long, n long, total long"


def share(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``1 + floor(10**9 * (count + 1) / size)`` by long division in three steps of 1000, so that nothing overflows."""
    left, found = np.broadcast_arrays(count + 1, size)[0].astype(np.int64), np.int64(0)
    for _ in range(3):
        left = left * 1000
        found = found * 1000 + left // size
        left = left % size
    return found + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def skyband(count: np.ndarray, total: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Which terms have fewer than ``k`` others with at least their ``count``, at most their ``total`` and an earlier ``place`` in UTF-8."""
    order = np.lexsort((place, total, -count))
    kept = np.zeros(len(order), bool)
    band_total, band_place = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(order), BLOCK):
        block = order[at : at + BLOCK]
        t, p = total[block], place[block]
        above = ((band_total[:, None] <= t) & (band_place[:, None] < p)).sum(axis=0)
        # Of the block's own terms, those that stand before.
        above += np.triu((t[:, None] <= t) & (p[:, None] < p), 1).sum(axis=0)
        stays = above < k
        kept[block[stays]] = True
        band_total, band_place = np.append(band_total, t[stays]), np.append(band_place, p[stays])
    return kept


def as_documents(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(docs[x].cast("string"), F.lit("")).alias(x) for x in ("text", "lang", "source")))


def partial_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of each term and documents that hold it, by language and source, for each slice of texts."""

    def of_slice(rows: pa.Table, texts) -> pa.RecordBatch:
        words = split_words(texts, NO_LETTER)
        coded = word_bytes(words).dictionary_encode()
        code, terms = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        lang, source = (rows.column(x).combine_chunks().dictionary_encode() for x in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * max(1, len(source.dictionary)) + source.indices.to_numpy()
        width = max(1, len(terms))
        held, times = np.unique(words.text * width + code, return_counts=True)  # each term once for each text
        pairs, place, docs_of = np.unique(group[held // width] * width + held % width, return_inverse=True, return_counts=True)
        n = np.bincount(place, times, minlength=len(pairs))  # below 2**53 in a slice
        group_of = pairs // width
        columns = [
            lang.dictionary.take(pa.array(group_of // max(1, len(source.dictionary)))),
            source.dictionary.take(pa.array(group_of % max(1, len(source.dictionary)))),
            terms.take(pa.array(pairs % width)).cast(pa.binary()).cast(pa.string()),
            pa.array(n.astype(np.int64)),
            pa.array(docs_of.astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            for at, texts in chunks(batch.column("text"), SLICE_BYTES):
                yield of_slice(rows.slice(at, len(texts)), texts)

    return as_documents(docs).mapInArrow(task, PARTIAL)


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """A row for each kept term of a language: ``lang``, ``term``, ``sources`` (source and count, one entry a source at most)."""
    counts = partial_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    held = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return held.where(F.col("docs") >= min_docs).select("lang", "term", "sources")


def _compare(top: int):
    """The work of one language and salt: rows of kind 0 list the sources with their sizes, the others are terms with their counts."""

    def work(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            run = table.slice(int(start), int(end - start)).combine_chunks()
            heads = run.filter(pc.equal(run["kind"], 0))
            names = heads["source"].combine_chunks()
            lang = run["lang"][0].as_py()
            size, lang_size, v = (heads[x].to_numpy() for x in ("size", "lang_size", "kept"))
            body = run.filter(pc.equal(run["kind"], 1))
            terms = body["term"].combine_chunks()
            lists = body["sources"].combine_chunks()
            entries = lists.flatten()
            row = np.repeat(np.arange(len(body)), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
            column = pc.index_in(entries.field("source"), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64)
            n = entries.field("n").to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.zeros((len(names), len(names)), np.int64)
            rows_at_once = max(1, (1 << 20) // max(1, len(names)))
            for at in range(0, len(body), rows_at_once):
                here = (row >= at) & (row < at + rows_at_once)
                counts = np.zeros((min(rows_at_once, len(body) - at), len(names)), np.int64)
                counts[row[here] - at, column[here]] = n[here]
                p = share(counts, size + v)
                for other in range(len(names)):
                    sums[:, other] += divergence(p, p[:, other : other + 1]).sum(axis=0)
            one, two = np.nonzero(~np.eye(len(names), dtype=bool))
            yield _found(lang, names.take(pa.array(one)), "pair", names.take(pa.array(two)), sums[one, two])
            if not len(body):
                continue
            total = np.bincount(row, n, minlength=len(body)).astype(np.int64) if n.sum() < 1 << 53 else _exact_sums(row, n, len(body))
            q = share(total, lang_size[:1] + v[:1])
            place = np.empty(len(body), np.int64)
            place[pc.sort_indices(terms.cast(pa.large_binary())).to_numpy()] = np.arange(len(body))
            p = share(n, (size + v)[column])
            order = np.argsort(column, kind="stable")
            order = order[(n[order] > 0) & (p[order] > q[row[order]])]
            for source, chosen in _runs_of(column, order):
                at = row[chosen]
                stays = skyband(n[chosen], total[at], place[at], top)
                chosen, at = chosen[stays], at[stays]
                items = terms.take(pa.array(at))
                yield _found(lang, names.take(pa.array(np.full(len(at), source))), "term", items, divergence(p[chosen], q[at]), n[chosen], total[at])

    return work


def _exact_sums(row: np.ndarray, n: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, np.int64)
    np.add.at(out, row, n)
    return out


def _runs_of(column: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The parts of ``order`` that hold one value of ``column``, which it is sorted by."""
    values = column[order]
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return ((int(column[part[0]]), part) for part in np.split(order, cuts) if len(part))


def _found(lang: str, source: pa.Array, part: str, item: pa.Array, value: np.ndarray, n=None, total=None) -> pa.RecordBatch:
    zeros = np.zeros(len(source), np.int64)
    columns = [
        pa.array([lang] * len(source), pa.string()),
        source.cast(pa.string()),
        pa.array([part] * len(source), pa.string()),
        item.cast(pa.string()),
        *(pa.array(zeros if x is None else x) for x in (value, n, total)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "part", "item", "value", "n", "total"])


def merge(found: DataFrame, top: int) -> DataFrame:
    """One skyband of several, for each ``lang``, ``source`` and ``salt``."""

    def work(table: pa.Table, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            run = table.slice(int(start), int(end - start)).combine_chunks()
            place = np.empty(len(run), np.int64)
            place[pc.sort_indices(run["item"].combine_chunks().cast(pa.large_binary())).to_numpy()] = np.arange(len(run))
            stays = skyband(run["n"].to_numpy(), run["total"].to_numpy(), place, top)
            yield from run.filter(pa.array(stays)).drop_columns(["salt"]).combine_chunks().to_batches()

    return by_runs(found, ["lang", "source", "salt"], work, FOUND)


def audit(docs: DataFrame, top: int = TOP, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value`` and ``rank``; terms up to rank ``top``, all pairs."""
    spark = docs.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = materialize(kept_terms(docs, min_docs), "kept_terms")
    groups = as_documents(docs).select("lang", "source").distinct()
    sizes = kept.select("lang", F.explode("sources").alias("x")).groupBy("lang", "x.source").agg(F.sum("x.n").alias("size"))
    languages = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    lang_sizes = sizes.groupBy("lang").agg(F.sum("size").alias("lang_size"))
    heads = groups.join(sizes, ["lang", "source"], "left").join(languages, "lang", "left").join(lang_sizes, "lang", "left")
    number = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    heads = heads.select("lang", "source", number("size"), number("lang_size"), number("kept"))
    # Every task of a language needs its sources; they are as many rows as the result has sources, once for each task.
    heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumn("kind", F.lit(0))
    terms = kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(salts)).cast("int")).withColumn("kind", F.lit(1))
    both = heads.unionByName(terms, allowMissingColumns=True)
    found = materialize(by_runs(both, ["lang", "salt"], _compare(top), FOUND, order=["kind"]), "found")
    pairs = found.where(F.col("part") == "pair").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    bands = found.where(F.col("part") == "term")
    bands = bands.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(-(-salts // MERGE))).cast("int"))
    terms = merge(bands, top).select("lang", "source", "part", "item", "value")
    best = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = [x.withColumn("rank", F.row_number().over(best)) for x in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))


def audit_sql() -> str:
    """The same rows in SQL, from dense counts."""
    return SQL


SQL = r"""
with docs as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
),
words as (
  select doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
),
by_doc as (select doc, lang, source, term, count(*) as n from words group by all),
kept as (select lang, term, sum(n)::hugeint as total from by_doc group by all having count(*) >= 3),
vocabulary as (select lang, count(*)::hugeint as v, sum(total) as size from kept group by all),
counted as (select lang, source, term, sum(n)::hugeint as n from by_doc semi join kept using (lang, term) group by all),
sizes as (select lang, source, sum(n) as size from counted group by all),
groups as (select distinct lang, source from docs),
shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (coalesce(s.size, 0) + v.v) as p,
    1 + (1000000000::hugeint * (k.total + 1)) // (v.size + v.v) as q
  from groups g join kept k using (lang) join vocabulary v using (lang)
    left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
    left join sizes s on s.lang = g.lang and s.source = g.source
),
pair_sums as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join pair_sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from shares where n > 0 and p > q
),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from parts)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 200
"""
