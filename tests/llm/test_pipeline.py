"""The stages, each against a plain form of itself on its own input."""

from __future__ import annotations

from pathlib import Path

import corpus_pipeline
import pyarrow as pa
import pytest
from test_jaccard_links import plain

from tidewell.llm import compression_score, queries, repetition
from tidewell.session import discarding_cuts, materialize, scratch_root


def test_stages(spark, sf_dir, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "near duplicates", "packing"]
    docs = documents
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "test")
        assert docs.columns == documents.columns
        kept.append(docs.toPandas().sort_values("doc_id").reset_index(drop=True))
    source = documents.toPandas().sort_values("doc_id").reset_index(drop=True)
    clean = source[repetition.measure_column(pa.array(source.text))["kept"]].reset_index(drop=True)
    assert kept[0].equals(clean)
    model = compression_score.train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = clean[[x >= 0.5 for x in model.score(clean.text.tolist())]].reset_index(drop=True)
    assert kept[1].equals(good)
    classes = {row[3] for row in plain(list(zip(good.doc_id.tolist(), good.text, strict=True)))}
    assert kept[2].doc_id.tolist() == sorted(classes)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {row.doc_id for row in packed.select("doc_id").distinct().collect()} == set(kept[2].doc_id)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    ran = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, ran.select(columns).collect())) == sorted(map(tuple, packed.select(columns).collect()))


def test_stages_carry_other_columns_and_take_awkward_rows(spark, sf_dir, awkward, no_rows):
    for df in (awkward, no_rows):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf_dir), "test")
            assert docs.columns == df.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()


@pytest.mark.parametrize("name", ["op4_bit_packed_tokens", "op6_best_fit_packing", "op8_warc_dictionary", "op11_byte_contexts", "op13_term_skyband"])
def test_nothing_is_left_in_the_shared_folder(spark, sf_dir, name):
    root = Path(scratch_root(spark).removeprefix("file://"))
    before = set(root.iterdir()) if root.exists() else set()
    with discarding_cuts(spark):
        assert queries.queries()[name](spark, sf_dir).collect()
        assert set(root.iterdir()) > before
    assert set(root.iterdir()) == before


def test_queries_are_registered():
    import __spark_entry__ as entry_points

    assert set(queries.queries()) <= set(entry_points.queries())
    assert set(queries.oracle_sql()) <= set(queries.queries())
