"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, html_text, line_dedup, merkle, mixing, mtree, pii, quality_rules, ranker, simhash, spelling, token_ids, training_order
from ..session import arrow_batches, ensure_checkpoint_dir, materialise
from .common import table

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql.strip()
        return fn

    return register


@query(r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(mixing.SQL)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query()
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op8_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return ranker.scored(documents, ranker.fit(documents, labels))


@query()
def op2_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


@query()
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query()
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pii.detected(documents, pii.fit(documents))


@query()
def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the token ids as shards beside the shared tables; one row per sequence, read from them."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    words = public_tokenizers.path("word_bpe_49k.json")
    vocab = bpe.vocabulary(words)
    end = len(vocab.tokens)  # two ids past the vocabulary end and pad
    with arrow_batches(spark, token_ids.PORTION):
        # written once: counted and cut from the same files, without encoding twice
        tokens = materialise(token_ids.token_ids(table(spark, sf_dir, "documents"), words), "token_ids", compression="zstd")
        layout = training_order.write_shards(tokens, path, free=True, waves=8, width=4, id_width=token_ids.id_width(vocab), end=end, pad=end + 1)
    return training_order.read_shards(spark, path, layout).select(
        "slot", "shard", "byte_offset", "sequence", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))


@query()
def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@query(spelling.SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


@query(merkle.SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query(mtree.SQL)
def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"))
