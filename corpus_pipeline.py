"""A corpus pipeline: language, exact copies, near copies, mixing, encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of ``documents``, and any further ones as they are, whatever they are called.
Texts are read whole. A stage on an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import bpe, common, exact, langid, mixing, simhash
from linkloom.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose text is in a language: NULL texts and those without a letter go.

    Repeated rows stay; rows without id are not learned from, but kept alike.
    """
    return langid.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first of equal texts: the smallest doc_id, NULL ids last; of repeated rows one.

    NULL texts equal empty ones.
    """
    return exact.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: the smallest doc_id, NULL ids last; of repeated rows one.

    NULL and empty texts have the same fingerprint, zero.
    """
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them, at most twice.

    A NULL source is a source of its own; texts without words are not taken. Reruns agree; which of two
    repeated rows is taken is not defined, how many of them is.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of their encoded and decoded forms.

    One row per row; NULL texts are empty: no token, digests of nothing. Other columns are left out.
    """
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(docs, path, keep=["doc_id", "lang", "source"], tokens=True)


STAGES = [
    ("language identification", identify_language),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("encoding", encode),
]

#: SQL cannot express the trained network nor the tokenizer; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = common.documents(spark, sf_dir)
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = materialize(docs, f"pipeline-{n}")
    return docs
