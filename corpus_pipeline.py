"""From raw documents to an encoded training mix, in five stages that Spark writes and rereads.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from revrank.llm.language_id import held_out, keep_identified, train_filters
from revrank.llm.mixing import mixed_documents
from revrank.llm.near_dedup import drop_near_duplicates
from revrank.llm.pii import sanitise
from revrank.llm.sentencepiece_bpe import encode_texts
from revrank.session import checkpoint_folder

TOKENIZER = "piece_bpe_32k.model"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language learned from the labelled ones."""
    return keep_identified(docs, train_filters(docs.filter(~held_out())))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    return drop_near_duplicates(docs, words=5, similarity=0.8)


def remove_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what reveals it replaced."""
    return sanitise(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, by weights 1, 2, 3 over the sources."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids with end id, and the text they decode to."""
    return encode_texts(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", near_dedup),
    ("pii", remove_pii),
    ("mix", mix),
    ("sentencepiece", encode),
]

# Language filters, MinHash and piece merges are beyond SQL; tests check every stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
