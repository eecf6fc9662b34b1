"""The document pipeline: each stage keeps or rewrites documents and hands a written table to the next.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one the ids of the pieces.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlab.llm import decontam, langid, neardup, pieces, pii, transducer
from barlab.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language cannot be told, go."""
    return langid.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near-duplicates the document with the smallest id stays."""
    return neardup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; a document of nothing else goes."""
    return decontam.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; every document stays."""
    return pii.redact(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text's pieces, and what decoding them gives."""
    return transducer.encode(docs, pieces.load(spark))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact_pii),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None  # a fitted model decides in the first stage; the tests compare stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents; what a stage returns is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
