"""Registered queries of the numbered operators, with the parameters of their contracts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabulon.llm import (collocations, conversations, exact_dedup, line_dedup, mixing, packing, piece_codec, quality_rules,
                         secret_scan, sharding, simhash, token_counts, url_filter)
from tabulon.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document under the word-level BPE vocabulary."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("word_bpe_49k.json"), limit=2048)


#: Bytes of a shard, with a line end for each document.
SHARD_BYTES = 1 << 20


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, by extendible hashing of ids."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line runs that occur earlier in the corpus."""
    return line_dedup.deduplicate_lines(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"), words_per_shingle=3, budget=2)


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded to pieces with source offsets, and decoded back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.digests(piece_codec.encode(table(spark, sf_dir, "documents"), model, decoded=True))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole document, also inside encoded layers; counts are of base spans."""
    return secret_scan.report(secret_scan.find_secrets(table(spark, sf_dir, "documents"), ["doc_id"]))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts, and the row that stays, of every document."""
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, by the base rule and the learned list."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, tokenized and cut, packed into sequences of at most 1024 tokens."""
    pieces = packing.piece_table(table(spark, sf_dir, "documents"),
                                 public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    return packing.pack(pieces, capacity=1024)


URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page, by rule or by boosted trees."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources by target weights takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    return conversations.summaries(rows, conversations.damaged(rows))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best collocations of two and three words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_sharding, op3_line_dedup, op4_simhash_near_dedup, op5_piece_codec, op6_secret_scan, op7_exact_dedup, op8_quality_rules, op9_best_fit_packing, op10_url_filter,
        op11_mixing, op12_conversation_repair, op13_collocations)
}
ORACLE_SQL: dict[str, str] = {
    "op2_sharding": sharding.oracle_sql(SHARD_BYTES),
    "op3_line_dedup": line_dedup.oracle_sql(),
    "op7_exact_dedup": r"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY body) AS group_size,
               row_number() OVER w = 1 AS kept,
               sha256(body) AS text_sha256
        FROM rows
        WINDOW w AS (PARTITION BY body ORDER BY n_chars DESC, doc_id NULLS LAST)""",
    "op11_mixing": mixing.oracle_sql(),
    "op13_collocations": collocations.oracle_sql(),
}
