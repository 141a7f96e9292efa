"""A corpus pipeline out of the operators of heartspark.llm.

Documents that the quality rules reject go; of each class of near duplicates the document with the
least id stays; documents that overlap with the benchmark go; secrets in the rest are replaced by a
mark; what is left is encoded to byte-pair ids. Each stage works on all that its predecessor kept.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heartspark.llm import byte_bpe, decontaminate, near_dups, quality, secrets
from heartspark.llm.queries import rank_file
from heartspark.session import scratch_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``n_chars`` follows the text, which loses secrets and gains marks."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, exact), exact saying that the ids decode to the text."""
    return byte_bpe.encode(docs, rank_file(), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", redact_secrets),
    ("byte-level BPE", encode),
]

#: Near duplicates and BPE are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what each keeps is written as Parquet in the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
