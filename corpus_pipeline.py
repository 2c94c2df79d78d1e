"""A training corpus from raw documents, in five stages; each is written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from deedmill.llm import langid, mixing, piecemerge, pii, simhash
from deedmill.llm.common import shared_folder, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language, or none that can be told, go."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates by SimHash, the document with the smallest id stays."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind."""
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, put in the order in which sources take turns at their target weights."""
    return mixing.mixed(docs, mixing.WEIGHTS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, counted and hashed, and the hash of what they decode to, with the slot of the mix that the order of the documents gives."""
    placed = mixing.slots_in_order(docs, mixing.WEIGHTS).select("row.doc_id", "row.text", "slot")
    return piecemerge.digests(placed, public_tokenizers.path("piece_bpe_32k.model"), "slot")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("pieces", pieces),
]

#: The stages are trained models, hashes and tokens; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`. Their files stay in the shared checkpoint folder, a new subfolder for each run."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
