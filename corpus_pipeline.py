"""A corpus from raw documents, in five stages.

Toxic documents go, then later copies of lines, then all but one document of every group of
near duplicates, then documents that hold a passage of a benchmark; what is left is encoded.
Every stage works on all rows that the one before it kept. Rows with a NULL id are judged by
their text like any other and are never copies of another row; a missing label or benchmark
table is an error, an empty one filters nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwatch.llm import bpe, decontaminate, line_dedup, minhash, toxicity
from meterwatch.llm.common import persist_table
from meterwatch.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEY = ["doc_id", "text_key"]


def _rows(docs: DataFrame) -> DataFrame:
    """The columns of documents and what tells rows apart."""
    return docs.select(*COLUMNS).withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))


def _without(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """``rows`` but those with a rejected key; a NULL id is equal to a NULL id."""
    rejected = rejected.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    same = (F.col("text_key") == F.col("gone_key")) & F.col("doc_id").eqNullSafe(F.col("gone_id"))
    return rows.join(rejected, same, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = toxicity.score_toxicity(docs, labels).filter("predicted = 1").select(*KEY)
    return _without(_rows(docs), toxic).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of a line go; text and n_chars are those of what stays."""
    touched = line_dedup.keep_bitmaps(docs).filter("n_dropped > 0")
    rows = _rows(docs)
    changed = rows.join(touched.select(*KEY), KEY, "left_semi").dropDuplicates(KEY)
    cut = line_dedup.apply_bitmaps(changed, touched).select(*KEY, F.col("text").alias("kept"))
    joined = rows.join(cut, KEY, "left")
    n_chars = F.when(F.col("kept").isNotNull(), F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))
    return joined.select("doc_id", F.coalesce("kept", "text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 80 % of their five-word shingles, directly or by way of others, the smallest id stays.

    Of rows that repeat id and text, the one with the smallest (lang, source, n_chars) stays, NULL first;
    rows with a NULL id all stay.
    """
    copies = minhash.near_duplicates(docs, width=5, percent=80).filter("not kept").select(*KEY)
    lone = F.when(F.isnull("doc_id"), F.monotonically_increasing_id())  # keeps rows without an id apart
    left = _without(_rows(docs).withColumn("lone", lone), copies)
    rest = ["lang", "source", "n_chars", "text"]
    single = left.groupBy(*KEY, "lone").agg(F.min(F.struct(*rest)).alias("one"))
    return single.select("doc_id", *[F.col(f"one.{c}").alias(c) for c in rest]).select(*COLUMNS)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaked = decontaminate.find_leaks(docs, benchmark, 10).filter("n_hit > 0").select(*KEY)
    return _without(_rows(docs), leaked).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the digest of what the ids decode to."""
    both = bpe.encode_words(docs, tokenizer_path("word_bpe_49k.json"), decoded=True)
    return both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaked),
    ("bpe", encode),
]

#: SQL can express neither the classifier nor the tokenizer; the tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = persist_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
