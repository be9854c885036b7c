"""The corpus pipeline: five stages, each over all that the one before it kept.

quality    documents that the quality discriminant scores under 0.3 go
toxicity   documents that the toxicity model scores 0.5 or more go
dedup      one document of every n-gram Jaccard component stays
secrets    found secrets are masked in the text
packing    token pieces of the documents left, in windows of 1024 ids

Both classifiers are fitted on the labelled rows of their own stage's input
that aren't held out. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fareseg.llm import jaccard, packing, quality, secret_scan, toxicity
from fareseg.llm.common import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stats = written(quality.document_statistics(docs, keep=["doc_id"]), "stats")
    model = quality.fit(stats, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights, threshold=0.5)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicated(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.piece_digests(docs)


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("dedup", dedup_stage), ("secrets", secrets_stage),
          ("packing", packing_stage)]

#: SQL can't express the trained stages; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
