"""The corpus pipeline: from documents to packed training sequences.

Each stage takes all rows of the one before it. All but the last return the
columns of documents; the last one returns the pieces of the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from measlake.llm import mixing, packing, quality, secrets, simhash
from measlake.llm.common import configure, kept, table
from measlake.llm.queries import word_tokenizer

# Learning, random-access packing and fingerprints are not SQL; the tests state the stages plainly.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    configure(spark)
    return simhash.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mask in place of each secret."""
    configure(spark)
    masked = secrets.mask_secrets(docs)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, a row per copy; sources by their weights."""
    configure(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    configure(spark)
    return packing.digest(packing.pack(docs, word_tokenizer()))


STAGES = [
    ("quality classifier", keep_good),
    ("simhash near-dedup", keep_one_of_each),
    ("secret scans", mask_secrets),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each one's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = kept(docs, f"pipeline-{number}")
    return docs
