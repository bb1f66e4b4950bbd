"""The registered queries of this subpackage: name -> function of (session, folder)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triptych.llm import (
    alignment,
    chat,
    collocations,
    dedup,
    katz,
    language,
    mixing,
    near,
    neighbours,
    packing,
    sharding,
    urls,
    vectorfile,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")

URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), TOKENIZER)


def op2_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(_table(spark, sf_dir, "documents"))


def op3_streaming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_report(_table(spark, sf_dir, "documents"))


def op4_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_snapshots(_table(spark, sf_dir, "conversations"))


def op5_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op6_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    like = near.Likeness(width=3, numerator=90, denominator=100)
    return near.near_report(_table(spark, sf_dir, "documents"), like)


def op7_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(embeddings, F.col("vec_id") % 50 == 0)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op10_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(_table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_TOKENIZER)


def op12_vector_file_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorfile.top_products(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        op1_best_fit_packing,
        op2_katz_scores,
        op3_streaming_dedup,
        op4_chat_snapshots,
        op5_pivotal_mix,
        op6_parity_join,
        op7_posting_lists,
        op8_url_filter,
        op9_language,
        op10_vector_sharding,
        op11_token_alignment,
        op12_vector_file_top,
        op13_collocations,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_streaming_dedup": dedup.DEDUP_SQL,
    "op4_chat_snapshots": chat.COLLAPSE_SQL,
    "op12_vector_file_top": vectorfile.TOP_SQL,
    "op13_collocations": collocations.COLLOCATIONS_SQL,
}
