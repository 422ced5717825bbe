"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import minhash, packing, quality_classifier, quality_rules, secrets
from corpusloom.llm.common import discard, staged


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a risk-controlled cutoff go.

    Null and empty texts have no words and go. A text is measured as a whole,
    however long. Rows are judged one by one: repeated ones share a verdict,
    and rows of one id with different texts have verdicts of their own; a value
    just at a cutoff stays. With no or few labels only the base rules decide.
    An empty table stays empty.
    """
    return quality_rules.accepted(docs, _labels(spark, sf_dir))


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for low quality go.

    Null and empty texts have a score as well; it is made from whole texts,
    however long; rows with equal texts share it, whatever their ids, and a
    score just at the threshold stays. Without labels of good texts every score
    is 0.5, and all stay. An empty table stays empty.
    """
    return quality_classifier.accepted(docs, _labels(spark, sf_dir))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays: that with the smallest id, and of repeated rows of an id one.

    Null texts and those without words are like nothing else, texts of fewer
    than five words are one shingle; documents without id all stay. Texts of
    one id are one class, so that of two unrelated texts of an id one goes on.
    Texts are compared as a whole, however long. An empty table stays empty.
    """
    return minhash.deduplicated(docs)


def secret_scan_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mask; no document goes.

    Null and empty texts stay as they are, repeated rows and rows without id
    are treated alike, very long texts are gone through in segments. An empty
    table stays empty.
    """
    return secrets.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document with its place in a sequence.

    Null and empty texts are their end id alone; a very long text is cut into
    windows and a rest; repeated rows, and rows with equal or null ids, are
    packed each; of equal lengths a hash decides which lies where. An empty
    table gives no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scan", secret_scan_stage),
    ("packing", packing_stage),
]

#: The stages' learned cutoffs, signatures and packing can't be said in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a data directory; each result is written and read again, and removed once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
        if before:
            discard(spark, before)
        before = docs._staged_path
    return STAGES[-1][1](spark, docs, sf_dir)
