"""From raw documents to token ids: five stages, each written and read again by the next.

1 language ID drops texts of no known language; 2 exact dedup keeps the first of equal
texts; 3 near dedup keeps one document of each class; 4 mixing draws the sources by their
target weights, a document once for each draw; 5 byte-level BPE encodes what was drawn.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crosstally.llm import bpe, digest_index, language, mixing, order_minhash
from crosstally.llm.common import saved, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest_index.drop_copies(docs, digest_index.DigestIndex(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_texts(docs, vocabulary, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: Model fitting and edit alignment have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
