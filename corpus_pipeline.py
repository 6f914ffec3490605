"""A training corpus from ``documents``: quality rules, exact dedup, near-duplicate
removal, mixing to source weights, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next
stage's docs.  All but the last return the columns of ``documents``; the last
returns the packed pieces.  A document that the mix takes twice is two rows
with one id from there on.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vachan.llm import exact_dedup, mixing, ngram_join, packing, quality
from vachan.llm.common import store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the outlier test (op 2)."""
    return quality.keep_clean(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, A-Z lowered, by a digest index of this run (op 8)."""
    index = f"llm_pipeline_index_{uuid.uuid4().hex}"
    kept = exact_dedup.keep_rows(docs, index, "batch-0")
    spark.sql(f"DROP TABLE {index}")  # the rows to keep are written already; no later run reads this index
    return kept


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 (op 7)."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source targets ask for (op 6)."""
    return mixing.expand(docs, mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens (op 1)."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Robust estimates and token ids can't be stated in SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
