"""Documents to packed training sequences: language, near duplicates, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meetmart.llm import jaccard, langid, packing, pii
from meetmart.llm.queries import PII_KEY
from meetmart.llm.texts import in_share, read_table
from meetmart.sources.scratch import materialized


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns languages from `docs` (but for the quarter held out) and drops texts without any."""
    model = langid.train(docs, ~in_share(F.col("doc_id"), 4, 2))
    return langid.determined(docs, model)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    return jaccard.one_of_each_class(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and mail names become pseudonyms; lengths follow the new texts."""
    replaced = pii.pseudonymize(docs, PII_KEY)
    return replaced.withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, in sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", keep_known_language),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

#: No SQL can express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written as Parquet and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
