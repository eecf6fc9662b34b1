"""The registered queries: thin calls of the operators over whole tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlab.llm import decontam, divergence, extract, fingerprint, langid, lmscore, merkle, neardup, pieces, pii, repeats, secrets, transducer, warc
from barlab.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(documents(spark, sf_dir))


@query("op4_fingerprint", fingerprint.ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.report(documents(spark, sf_dir))


@query("op7_benchmark_decontamination", decontam.ORACLE)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


@query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.encode(documents(spark, sf_dir), pieces.load(spark))


@query("op6_secrets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(documents(spark, sf_dir))


@query("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op10_minhash_near_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.report(documents(spark, sf_dir))


@query("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(documents(spark, sf_dir))


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(documents(spark, sf_dir))


@query("op13_merkle_manifest", merkle.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


@query("op11_divergence_audit", divergence.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


@query("op12_warc_index", warc.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(spark.read.parquet(f"{sf_dir}/pages.parquet"))
