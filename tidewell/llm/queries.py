"""The operators as queries over the given tables, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    best_fit,
    byte_contexts,
    compression_score,
    jaccard_links,
    licence_rules,
    norm_buckets,
    polytope,
    prefix_bpe,
    repetition,
    term_skyband,
    token_store,
    url_cascade,
    warc_archive,
)
from tidewell.llm.ship import ship_package

ALLOW = ["com/", "www.example.com/en/"]
BLOCK = ["example.com/en/", "net/es/", "net/fr/"]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return url_cascade.judge(_table(spark, folder, "pages"), ALLOW, BLOCK)


def op2_cross_polytope(spark: SparkSession, folder: str) -> DataFrame:
    return polytope.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    encoded = prefix_bpe.encode(_table(spark, folder, "documents"), tokenizer)
    return prefix_bpe.digests(prefix_bpe.decode(encoded, tokenizer))


def op4_bit_packed_tokens(spark: SparkSession, folder: str) -> DataFrame:
    manifest = token_store.write_tokens(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return token_store.read_tokens(manifest).select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))


def op5_compression_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return compression_score.score(docs, compression_score.train(docs, _table(spark, folder, "labels")))


def packed_rows(docs: DataFrame) -> DataFrame:
    """Place and digest of each piece of each document."""
    pieces, placed = best_fit.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    digests = pieces.select("piece_key", "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"))
    return digests.join(placed, "piece_key").drop("piece_key")


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_rows(_table(spark, folder, "documents"))


def op7_repetition_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.judge(_table(spark, folder, "documents"))


def op8_warc_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc_archive.write_archives(_table(spark, folder, "pages"))
    return warc_archive.read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_licence_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return licence_rules.scan(_table(spark, folder, "documents"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    links = jaccard_links.classes(_table(spark, folder, "documents"))
    return links.select("doc_id", "class_id", "n_links", "n_text_links", "n_copies")


def op11_byte_contexts(spark: SparkSession, folder: str) -> DataFrame:
    return byte_contexts.score(_table(spark, folder, "documents"))


def op12_norm_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return norm_buckets.search(_table(spark, folder, "benchmark"), _table(spark, folder, "documents"))


def op13_term_skyband(spark: SparkSession, folder: str) -> DataFrame:
    return term_skyband.audit(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    found = [
        op1_url_cascade,
        op2_cross_polytope,
        op3_prefix_bpe,
        op4_bit_packed_tokens,
        op5_compression_classifier,
        op6_best_fit_packing,
        op7_repetition_rules,
        op8_warc_dictionary,
        op9_licence_sentences,
        op10_jaccard_join,
        op11_byte_contexts,
        op12_norm_buckets,
        op13_term_skyband,
    ]
    return {query.__name__: query for query in found} | {"pipeline": corpus_pipeline.run}


URL_SQL = """
with parsed as (
  select page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages
),
fitted as (
  select *,
    case when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
         when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
         when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
         when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
         when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule
  from parsed
)
select page_id, host, path, rule, case when rule in ('example.com/en/', 'net/es/', 'net/fr/') then 'block' else 'allow' end as verdict
from fitted
"""

WARC_SQL = """
with sized as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
),
grouped as (select *, min(page_id) over (partition by payload_digest) as first_id from sized)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from grouped
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_cascade": URL_SQL,
        "op8_warc_dictionary": WARC_SQL,
        "op9_licence_sentences": licence_rules.scan_sql(),
        "op12_norm_buckets": norm_buckets.search_sql(),
        "op13_term_skyband": term_skyband.audit_sql(),
    }
