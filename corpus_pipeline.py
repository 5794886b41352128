"""Corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next one's ``docs``.  All but the last return the columns
of ``docs`` as they came, whatever further columns there are.

1. quality rules: documents that the base rule or the learned list rejects go;
2. exact dedup: of equal texts the longest, then the smallest id stays;
3. SimHash near-dedup: of each component the smallest id stays;
4. secret scans: every character of a secret becomes ``*`` (lengths stay);
5. best-fit packing: the rest as pieces in sequences of at most 1024 tokens.

Documents with a null text fail the first stage; an empty table gives an empty table.
No SQL can express the learned list and the fingerprints, so there is no
oracle; the tests hold ``run`` against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabulon.llm import exact_dedup, packing, quality_rules, secret_scan, simhash
from tabulon.session import recorded_scratch, remove_path, ship_package, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.first_of_equals(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_near_duplicates(docs, words_per_shingle=3, budget=2)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.piece_table(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    return packing.pack(pieces, capacity=1024)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("secret_scan", secrets),
    ("best_fit_packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the documents that all stages keep, with their place in the packed sequences."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        with recorded_scratch() as used:
            result = work(spark, docs, sf_dir)
        docs = stage(result, name)
        for path in used:  # the stage's own files; its result is written
            remove_path(spark, path)
    return STAGES[-1][1](spark, docs, sf_dir)
