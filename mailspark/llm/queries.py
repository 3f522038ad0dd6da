"""The registered queries of this package: each applies its operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mailspark.llm import alignment, chat, collocations, embed_dedup, fingerprint, langid, minhash, packing, passages, quality, secret_scan, sentencepiece_fst, sharding
from mailspark.llm.common import table

PACK = packing.PackConfig(tokenizer=public_tokenizers.path("word_bpe_49k.json"))
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ALIGN = alignment.AlignConfig(public_tokenizers.path("byte_bpe_50k.json"), PIECES, public_tokenizers.PATTERN)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text", "lang"), table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality.quality_verdicts(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"
    )


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), minhash.MinMax(shingle=3, percent=85))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_plan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return langid.predict(docs, langid.fit(docs))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.coding_report(table(spark, sf_dir, "documents", "doc_id", "text"), PIECES)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.vector_links(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), PACK)


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_report(table(spark, sf_dir, "documents", "doc_id", "text"), ALIGN)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_neighbours(table(spark, sf_dir, "documents", "doc_id", "text"))


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality_rules, op2_minhash_dedup, op3_sharding, op4_language_id, op5_secret_scan,
            op6_chat_perspectives, op7_sentencepiece, op8_embedding_dedup, op9_packing, op10_repeated_passages, op11_token_alignment, op12_collocations,
            op13_fingerprints,
        )
    }


def oracle_sql() -> dict[str, str]:
    from mailspark.llm import sql_text

    return sql_text.oracles()
