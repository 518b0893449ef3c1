"""Corpus pipeline: quality, exact and near copies, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what a stage
returns is written as Parquet and read again as the next stage's docs.  All
but the last return the columns of ``documents``; the last returns doc_id,
n_tokens, ids_sha256, decoded_sha256 and the ids themselves.  SQL cannot
express the classifier, so there is no oracle; the stages are tested against
brute-force versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roadlens.llm import bpe, exact_dedup, mixing, ranker, simhash
from roadlens.llm.common import table
from roadlens.session import materialise

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts.  Null texts are scored as empty ones; rows that
    repeat an id or a text are scored alike; an empty table stays empty.
    """
    return ranker.accepted(docs, ranker.fit(docs, table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the smallest doc_id (null last), of rows equal in id
    and text the first by a hash of all columns.  Null texts equal empty ones.
    """
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component, chosen as in ``exact``.  Texts without words share the
    fingerprint zero and are one component.
    """
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as its source's rate says; a null source is a source of its own, empty
    texts are taken at their source's rate, reruns agree.
    """
    return mixing.emit(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's whole text; null texts have none, repeated rows repeat.
    """
    return bpe.encoded(docs, VOCABULARY)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("source_mixing", mix),
    ("bpe_encoding", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
