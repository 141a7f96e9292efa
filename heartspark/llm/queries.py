"""The registered queries of this subpackage, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat, class_lm, conversation_repair, decontaminate, html_text, language_id, near_dups, oracles, quality, secrets, token_count, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rank_file(name: str = "byte_bpe_50k.tiktoken") -> bytes:
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(_table(spark, sf_dir, "documents"), rank_file(), public_tokenizers.PATTERN)


def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_html_min_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op4_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    both = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", both), (-7, 1, "assistant", both)], table.schema)
    turns = chat.paths(chat.linear_tree(table.unionByName(added)))
    return chat.digests(chat.format_paths(turns))


def op5_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = secrets.scan(_table(spark, sf_dir, "documents"))
    return secrets.digests(findings)


def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents")).drop("excess")


def op7_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = F.coalesce(language_id.held_out(), F.lit(False))
    learned = language_id.learn(docs.where(~out).select("text", "lang"))
    return language_id.predict(docs, learned).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def warc_of_pages(pages: DataFrame) -> DataFrame:
    """WARC records made of pages: a full response each, and a revisit some time before or after it."""
    body = F.coalesce("html", F.lit(""))
    tag = F.concat(F.lit('"'), F.substring(F.sha2(body, 256), 1, 16), F.lit('"'))
    minute = F.coalesce("page_id", F.lit(0))
    shift = F.conv(F.substring(F.sha2(F.coalesce("url", F.lit("")), 256), 1, 4), 16, 10).cast("long") % 4001 - 1000
    rows = pages.select("page_id", "url", body.alias("body"), tag.alias("tag"),
                        (1_600_000_000 + 60 * minute).alias("s"), (1_600_000_000 + 60 * (minute + shift)).alias("s2"))
    response = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("body").cast("string"),
        F.lit("\r\nCache-Control: max-age=60\r\nDate: "), F.col("s").cast("string"), F.lit("\r\nETag: "), F.col("tag"), F.lit("\r\n\r\n"), F.col("body"))
    revisit = F.concat(
        F.lit("HTTP/1.1 304 Not Modified\r\nContent-Length: 0\r\nCache-Control: max-age=120\r\nDate: "), F.col("s2").cast("string"),
        F.lit("\r\nETag: W/"), F.col("tag"), F.lit("\r\n\r\n"))

    def record(kind: str, second: str, http):
        return warc.write_record(F.lit(kind), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("url"), F.timestamp_seconds(second), http)

    return rows.select(F.explode(F.array(record("response", "s", response), record("revisit", "s2", revisit))).alias("record"))


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = warc.resolve(warc.parse_records(warc_of_pages(_table(spark, sf_dir, "pages"))))
    return done.select(F.col("record_id").cast("long").alias("page_id"), "canonical_url", F.col("target_id").cast("long").alias("target_page_id"),
                       "outcome", "headers")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(
        _table(spark, sf_dir, "documents"), rank_file("byte_bpe_50k.json").decode(), public_tokenizers.PATTERN)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_digests(_table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(_table(spark, sf_dir, "documents"), class_lm.held_out())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_byte_bpe, op2_spaced_seeds, op3_html_min_cut, op4_chat_trees, op5_secret_ledger, op6_quality_divergence, op7_bag_minhash, op8_language_filters,
    op9_warc_revisits, op10_token_counts, op11_conversation_repair, op12_whitening, op13_class_lm)
}

#: DuckDB SQL of those that SQL can express.
SQL: dict[str, str] = {
    "op4_chat_trees": oracles.CHAT,
    "op5_secret_ledger": oracles.secrets(),
    "op9_warc_revisits": oracles.WARC,
    "op11_conversation_repair": oracles.CONVERSATIONS,
    "op6_quality_divergence": oracles.quality(),
}
