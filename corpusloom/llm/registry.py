"""The queries of this subpackage, over the tables of a data directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from corpusloom.llm import bpe, html_pages, minhash, nn_descent, packing, pii, quality_classifier, quality_rules, secrets, spelling, token_files, warc, whitening


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_read(spark, sf_dir, "documents"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_pages.extract(_read(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(_read(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents"))


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.links(_read(spark, sf_dir, "embeddings"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(_read(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_read(spark, sf_dir, "pages"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


QUERIES = (op1_bpe, op2_html, op3_packing, op4_minhash, op5_quality_classifier, op6_pii, op7_nn_descent, op8_token_files, op9_quality_rules, op10_secrets, op11_warc, op12_spelling, op13_whitening)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """No query of this subpackage has SQL: see the tests against brute force."""
    return {}
