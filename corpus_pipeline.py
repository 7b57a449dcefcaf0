"""The corpus pipeline: five operators in a row over ``documents``, each working on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``; the last returns a row for each packed piece.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from grainmill.llm.language_id import accept, train
from grainmill.llm.line_dedup import without_frequent_lines
from grainmill.llm.minhash import without_near_duplicates
from grainmill.llm.mixing import mixed_rows
from grainmill.llm.packing import pack_documents
from grainmill.runtime import settle

#: A text is rejected if no letter is in it, or no language reaches this score.
LEAST_LANGUAGE_SCORE = 0.3
#: A line that so many documents hold is dropped everywhere.
LINE_DOCS = 10
#: Words of a shingle, and the similarity in percent from which documents are near duplicates.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
VOCABULARY, SEQUENCE_TOKENS = "word_bpe_49k.json", 4096


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; the others go."""
    return accept(docs, train(docs), LEAST_LANGUAGE_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them hold."""
    return without_frequent_lines(docs, LINE_DOCS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return without_near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them; none more than three times."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    return pack_documents(docs, public_tokenizers.path(VOCABULARY), SEQUENCE_TOKENS)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("source_mixing", mixture),
    ("best_fit_packing", packing),
]

#: SQL can't express the trained model of the first stage; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
