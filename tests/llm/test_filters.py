"""URL cascade, classifier, licences: against plain loops, SQL and held-out labels."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from comparing import connect, oracle_rows, rows_by_name
from pyspark.sql import functions as F

import tidewell.llm.queries as llm_queries
from tidewell.llm import compression_score, licence_rules, url_cascade

PAGES = "page_id long, url string, host string, rule string, keys string, best string"


def judged(url, allow, block):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (found[1], found[2]) if found else ("", "")
    host = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in host)
    best = None
    for rules, verdict in ((allow, "allow"), (block, "block")):
        for rule in rules:
            name, prefix = url_cascade.split_rule(rule)
            if (host == name or host.endswith("." + name)) and path.startswith(prefix):
                best = max(best or (0, 0, "", ""), (len(rule), len(name), rule, verdict))
    return (host, path, best[2], best[3]) if best else (host, path, None, "allow")


def test_many_rules_equal_plain_matching(spark):
    draw = random.Random(4)
    names = ["com", "net", "example", "a", "b", "www", "x1"]
    host = lambda: ".".join(draw.choice(names) for _ in range(draw.randint(1, 4)))
    path = lambda: draw.choice(["", "/", "/en/", "/en/1", "/de", "/de/2/3"])
    allow, block = ([host() + path() for _ in range(150)] for _ in range(2))
    allow, block = sorted(set(allow)), sorted(set(block) - set(allow)) + allow[:1]  # one rule on both lists
    urls = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.Com", "x://y://z/en/", "http://Éx.com/en/\n1", "http://a.com:80/en/"]
    urls += [f"http://{host()}{path()}{draw.choice(['', '?q=/en/', '#/de', 'tail'])}" for _ in range(600)]
    pages = spark.createDataFrame([(i // 2, url, "c", "c", "c", "c") for i, url in enumerate(urls)], PAGES)
    rows = url_cascade.judge(pages, allow, block).collect()
    expected = [(i // 2, *judged(url, allow, block)) for i, url in enumerate(urls)]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))


def test_cascade_corrects_its_own_false_positives(spark):
    """Level 1 is made far too small, so that later levels have work to do; membership stays exact."""
    keys = [f"key{i}" for i in range(4000)]
    universe = spark.createDataFrame([(key,) for key in keys], "key string")
    listed = keys[::8]
    cascade = url_cascade.build_cascade(universe.limit(0), listed)
    assert len(cascade.levels) == 1
    cascade = url_cascade.build_cascade(universe, listed)
    assert len(cascade.levels) > 1
    found = {row.key for row in universe.where(cascade.holds(F.col("key"))).collect()}
    assert found == set(listed)


def test_no_rules_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "c", "c", "c", "c")], PAGES)
    assert [tuple(row) for row in url_cascade.judge(pages, [], []).collect()] == [(1, "a.b", "/c", None, "allow")]
    assert url_cascade.judge(pages.where("false"), ["com/"], ["net/"]).collect() == []


def test_url_filter_is_native(spark, sf_dir):
    plan = llm_queries.op1_url_cascade(spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Join", plan)


@pytest.mark.parametrize("name", sorted(llm_queries.oracle_sql()))
def test_sql(name, spark, sf_dir):
    df = llm_queries.queries()[name](spark, sf_dir)
    columns, expected = oracle_rows(connect(sf_dir), llm_queries.oracle_sql()[name])
    assert sorted(df.columns) == columns and rows_by_name(df.columns, df.collect()) == expected


def test_licences(spark, awkward, no_rows):
    mit = next(text for name, kind, text in licence_rules.RULES if (name, kind) == ("MIT", "text"))
    apache = "Licensed under the Apache License, Version 2.0."
    first, second = mit.split(". ", 1)
    rows = [
        (1, f"Copyright someone.\n{mit}\nOther words. {apache}"),
        (2, mit.upper().replace(" ", "\n", 0)),
        (3, f"{first}. Between. {second}"),  # interrupted
        (4, f"{apache} {apache}"),
        (5, "Unlicensed under the Apache License, Version 2.0."),
        (6, None),
    ]
    found = {row.doc_id: row for row in licence_rules.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i].licences for i in range(1, 7)] == ["Apache-2.0,MIT", "MIT", "", "Apache-2.0", "", ""]
    assert found[4].n_matches == 2 and found[3].n_sentences > 0 and found[6].n_sentences == 0
    rows = licence_rules.scan(awkward).collect()
    assert len(rows) == awkward.count() and [row.licences for row in rows if row.doc_id == 9] == ["MIT"]
    assert licence_rules.scan(no_rows).collect() == []


def test_bsd_rules_are_ordered_by_length(spark):
    text = {name: text for name, kind, text in licence_rules.RULES if kind == "text"}
    rows = [(1, text["BSD-3-Clause"]), (2, text["BSD-2-Clause"])]
    found = licence_rules.scan(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    assert [row.licences for row in found] == ["BSD-3-Clause", "BSD-2-Clause"]


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    model = compression_score.train(docs, labels)
    found = compression_score.score(docs, model).where("held_out").join(labels, "doc_id").where("quality is not null").toPandas()
    right = found.predicted == found.quality
    assert right.mean() > 0.95 and right[found.quality == 1].mean() > 0.97 and right[found.quality == 0].mean() > 0.75
    good, bad = found[found.quality == 1].score, found[found.quality == 0].score
    assert np.mean([(good > x).mean() for x in bad]) > 0.95
    assert abs(found.score.mean() - found.quality.mean()) < 0.05  # calibrated


def test_classifier_learns_nothing_from_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(compression_score.fold(F.col("doc_id")) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert compression_score.train(docs, labels) == compression_score.train(docs, turned)


def test_classifier_awkward_rows(spark, awkward, no_rows):
    labels = spark.createDataFrame([(3, 1, 0), (8, 0, 0), (None, 1, 0), (6, None, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    nothing = compression_score.train(awkward, labels)
    assert nothing == compression_score.Model()
    rows = compression_score.score(awkward, nothing).collect()
    assert len(rows) == awkward.count() and {(row.score, row.predicted) for row in rows} == {(0.5, 1)}
    assert compression_score.keep_good(awkward, nothing).count() == awkward.count()
    sf = "/root/testdata/sf0.1"
    model = compression_score.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    rows = compression_score.score(awkward, model).collect()
    assert all(0 <= row.score <= 1 for row in rows) and {row.score for row in rows if row.doc_id == 1} == {model.score([None])[0]}
    assert compression_score.score(no_rows, model).collect() == [] and compression_score.keep_good(no_rows, model).columns == no_rows.columns
