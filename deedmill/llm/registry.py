"""Queries of the operators of this folder, and the pipeline, for the driver's entry file."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from deedmill.llm import chat, editprint, idfile, langid, merkle, mixing, neighbours, piecemerge, pii, repair, simhash, suffixes, tokencount
from deedmill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_perspectives(spark: SparkSession, directory: str) -> DataFrame:
    return chat.rotate(table(spark, directory, "conversations"))


def op2_pii(spark: SparkSession, directory: str) -> DataFrame:
    return pii.find(table(spark, directory, "documents"))


def op3_mixing(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.query(table(spark, directory, "documents"))


def op4_simhash(spark: SparkSession, directory: str) -> DataFrame:
    return simhash.query(table(spark, directory, "documents"))


def op5_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return suffixes.query(table(spark, directory, "documents"))


def op6_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_sentencepiece(spark: SparkSession, directory: str) -> DataFrame:
    return piecemerge.digests(table(spark, directory, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    return neighbours.query(table(spark, directory, "embeddings"))


def op9_language(spark: SparkSession, directory: str) -> DataFrame:
    return langid.identify(table(spark, directory, "documents"))


def op10_edit_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    return editprint.query(table(spark, directory, "documents"))


def op11_merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    return merkle.query(table(spark, directory, "documents"))


def op12_token_files(spark: SparkSession, directory: str) -> DataFrame:
    return idfile.query(table(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_conversation_repair(spark: SparkSession, directory: str) -> DataFrame:
    return repair.repair(table(spark, directory, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_chat_perspectives, op2_pii, op3_mixing, op4_simhash, op5_suffix_dedup, op6_token_counts, op7_sentencepiece,
        op8_neighbours, op9_language, op10_edit_fingerprints, op11_merkle_manifest, op12_token_files,
        op13_conversation_repair,
    )
} | {"pipeline": corpus_pipeline.run}

SQL: dict[str, str] = {"op1_chat_perspectives": chat.SQL, "op3_mixing": mixing.sql()}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
