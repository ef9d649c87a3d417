"""Registered queries of the text operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import align, ann, bpe, common, exact, importance, langid, licences, mixing, pitman_yor, quality, sanitise, simhash, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(common.documents(spark, sf_dir))


@query
def op2_source_mixing(spark, sf_dir):
    return mixing.mix(common.documents(spark, sf_dir))


@query
def op3_ann_search(spark, sf_dir):
    common.prepare(spark)
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op5_license_scan(spark, sf_dir):
    return licences.scan(common.documents(spark, sf_dir))


@query
def op6_bpe(spark, sf_dir):
    return bpe.digests(common.documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(common.documents(spark, sf_dir))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@query
def op7_language_id(spark, sf_dir):
    return langid.predict_languages(common.documents(spark, sf_dir))


@query
def op8_quality(spark, sf_dir):
    return quality.predict_quality(common.documents(spark, sf_dir), _labels(spark, sf_dir))


@query
def op9_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(common.documents(spark, sf_dir), _labels(spark, sf_dir))


@query
def op4_pitman_yor_lm(spark, sf_dir):
    return pitman_yor.score_documents(common.documents(spark, sf_dir))


@query
def op11_importance_resampling(spark, sf_dir):
    docs = common.documents(spark, sf_dir)
    return importance.resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op13_token_alignment(spark, sf_dir):
    a, b = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.align(common.documents(spark, sf_dir), a, b)


@query
def op12_pii_sanitisation(spark, sf_dir):
    found = sanitise.find(common.documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
