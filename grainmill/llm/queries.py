"""The registered query of each operator, with production parameters, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.llm.embeddings import near_duplicates
from grainmill.llm.html_text import extract_pages
from grainmill.llm.language_id import identify, train
from grainmill.llm import minhash, oracles, quality, warc
from grainmill.llm.line_dedup import dedup_lines
from grainmill.llm.mixing import mix
from grainmill.llm.packing import pack_documents
from grainmill.llm.token_counts import count_tokens
from grainmill.runtime import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0).drop("file")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 4096)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 512)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_warc_round_trip": op2_warc_round_trip,
    "op3_source_mixing": op3_source_mixing,
    "op4_quality_rules": op4_quality_rules,
    "op5_language_id": op5_language_id,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_html_extraction": op9_html_extraction,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
}

ORACLES = oracles.ORACLES
