"""A training-data pipeline of five operators; each stage works on all that its predecessor kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from framelight.llm import dedup, language, mixing, packing, secret_scan
from framelight.llm.common import shared_dir, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text has a language go on, with lang as predicted; null texts and texts without a letter go.

    The model learns from the lang of the stage's own input.
    """
    found = language.identify(docs, language.fit(docs))
    return found.where(f"lang_pred <> '{language.UNDETERMINED}'").withColumn("lang", found["lang_pred"]).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the least doc_id: five-word shingles, similarity of 0.8 or more."""
    return dedup.deduplicated(docs, width=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay; each secret gives way to its kind in angle brackets."""
    return secret_scan.redacted(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their sequence and offset."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Tokenizers and fitted models are beyond SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole documents table; each stage's rows are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
