"""One query per operator of this package over its whole table, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterwatch.llm import (bpe, decontaminate, fim, line_dedup, minhash, packing, quality, secret_scan, substring, token_count,
                            toxicity, vector_dedup, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """A file of the installed public tokenizers; every operator takes any other path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _query(key: str, sql: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op1_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), 2048)


@_query("op2_secret_scan", secret_scan.SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(_table(spark, sf_dir, "documents"))


@_query("op3_vector_dedup", vector_dedup.SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"), 0.95)


@_query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.drop("text_key")


@_query("op5_minhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_digest(_table(spark, sf_dir, "documents"), 3, 85)


@_query("op6_substring_dedup", substring.SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passage_digest(_table(spark, sf_dir, "documents"), 50)


@_query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 1024)


@_query("op8_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@_query("op9_decontamination", decontaminate.SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 10)


@_query("op10_line_dedup", line_dedup.SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(_table(spark, sf_dir, "documents"), 10)


@_query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), 16)


@_query("op12_quality")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.drop("text_key")


@_query("op13_fill_in_middle", fim.SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_digest(_table(spark, sf_dir, "documents"), 7, 100, 50)
