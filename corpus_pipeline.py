"""A training corpus from raw documents: language, near-duplicates, benchmark leaks, secrets, packed sequences.

Each stage works on all that the one before it kept, calls one operator of ``tierflow.llm`` with production parameters,
and returns the columns of ``documents``; the last one returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import decontam, langid, packing, secret_scan, simhash
from tierflow.llm.base import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language (null and empty texts among them); fills missing labels in and replaces
    labels that the text clearly contradicts."""
    return langid.accepted(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group whose SimHash fingerprints (three-word shingles) differ in 3 bits or fewer.

    Null and empty texts share fingerprint zero and are one group; of rows equal in id and text one is kept.
    """
    return simhash.one_of_each(docs, max_bits=3, words_per_shingle=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; a null or empty text holds none and stays."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks credentials in the texts; no document goes. A null text becomes empty."""
    masked = secret_scan.redacted(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the token ids of each document into power-of-two sequences of at most 4096 tokens; an empty text is its end id."""
    return packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, longest=4096)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secrets),
    ("packing", packed),
]

#: No stage but the last could be put into SQL; the tests compare run() with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus of the table ``documents``; each stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
