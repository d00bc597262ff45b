"""Corpus pipeline: documents through the stages of STAGES, each written as Parquet and read by the next.

1. quality rules: rows that the posterior rejects go;
2. n-gram Jaccard join: one document of each group of near copies stays, that with the smallest doc_id;
3. benchmark decontamination: documents that hold a test item go;
4. PII: spans are replaced by their kind, other texts stay as they are;
5. SentencePiece: doc_id, ids, n_pieces, exact for every document left.

All stages but the last give the columns of documents. Null texts fail the quality rules; empty tables stay empty.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm.decontaminate import drop_contaminated
from helixframe.llm.jaccard import keep_one
from helixframe.llm.pieces import encode_pieces
from helixframe.llm.pii import redact_pii
from helixframe.llm.quality import keep_good
from helixframe.runtime import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_pii(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_pieces(docs)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontamination),
          ("PII", pii), ("SentencePiece", pieces)]

#: The quality posterior comes from an iteration, and pieces from an automaton, which SQL does not express; tests compare
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
